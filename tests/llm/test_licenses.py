"""Licence scan: notices anywhere in a text, siblings told apart, held against every window."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from brute import prose

from vitaldf.llm import license_scan
from vitaldf.llm.license_texts import TEMPLATES

MATCHER = license_scan.Matcher()


def names(text):
    return [n.license for n in MATCHER.notices(text)]


def text_of(spdx, which=0):
    return [t for n, t in TEMPLATES if n == spdx][which]


def wrapped(text, start, width=8, end="\n"):
    words = text.split()
    return end.join(start + " ".join(words[i:i + width]) for i in range(0, len(words), width))


def pairs(words):
    return set(zip(words, words[1:], strict=False))


def plain(text, templates, threshold):
    """Every window of words, ranked and chosen one by one."""
    words = re.findall("[a-z0-9]+", text.lower())
    codes = list(zip(words, words[1:], strict=False))
    rows = []
    for t, (name, template) in enumerate(templates):
        b = re.findall("[a-z0-9]+", template.lower())
        inside, reach = pairs(b), int((len(b) - 1) * (2 - threshold) / threshold + 1e-6)
        for s in range(len(codes)):
            if codes[s] not in inside or s and codes[s - 1] in inside:
                continue
            for e in range(s, len(codes)):
                if codes[e] not in inside or e + 1 < len(codes) and codes[e + 1] in inside:
                    continue
                if e - s >= reach and any(c not in inside for c in codes[s:e + 1]):
                    break
                a = set(codes[s:e + 1])
                dice = 2 * len(a & inside) / (len(a) + len(inside))
                if dice >= threshold:
                    rows.append((-len(a & inside), -dice, s, e, t, name, dice))
    kept = []
    for row in sorted(rows):
        if all(row[3] < k[2] or k[3] < row[2] for k in kept):
            kept.append(row)
    return [(k[5], k[6], k[2], k[3] + 2) for k in sorted(kept, key=lambda k: k[2])]


def best_dice(text, template):
    """The largest Dice of any window at all."""
    words, b = re.findall("[a-z0-9]+", text.lower()), pairs(re.findall("[a-z0-9]+", template.lower()))
    return max((2 * len(a & b) / (len(a) + len(b)) for s in range(len(words)) for e in range(s + 2, len(words) + 1)
                if (a := pairs(words[s:e]))), default=0)


@pytest.mark.parametrize("i", range(len(TEMPLATES)))
def test_each_template_is_found_as_itself_inside_prose(i):
    name, text = TEMPLATES[i]
    for shown in (text, text.upper(), wrapped(text, " * "), wrapped(text, "# ", 5, "\r\n")):
        found = MATCHER.notices(f"{prose(i, 40)} {shown} {prose(i + 50, 30)}")
        assert [n.license for n in found] == [name]
        assert found[0].dice == 1.0


def test_notice_after_and_before_other_words_of_its_line():
    assert names("All figures were drawn by the authors in spring. This work is licensed under the GNU General "
                 "Public License, version 3. See the appendix for the data.") == ["GPL-3.0"]


def test_wrapped_header_with_marks_on_blank_lines():
    header = wrapped(text_of("GPL-3.0", 1), " * ")
    assert names("/*\n * Copyright 2019 the authors\n *\n" + header + "\n *\n */\n" + prose(1, 60)) == ["GPL-3.0"]
    assert names((prose(2, 50) + "\r\n\r\n" + wrapped(text_of("MIT", 2), "", 9, "\r\n") + "\r\n\r\n"
                  + prose(3, 50))) == ["MIT"]


def test_siblings_are_told_apart():
    for spdx, _ in TEMPLATES:
        for which in range(sum(n == spdx for n, _ in TEMPLATES)):
            assert names(text_of(spdx, which)) == [spdx]
    assert names("This work is licensed under the GNU General Public License, version 2.") == ["GPL-2.0"]
    assert names("Licensed under CC BY-ND 4.0.") == ["CC-BY-ND-4.0"]
    assert names("Licensed under CC BY 3.0.") == ["CC-BY-3.0"]
    assert names(text_of("BSD-2-Clause").replace("holders", "owners")) == ["BSD-2-Clause"]


def test_all_notices_of_a_text_are_listed():
    text = " ".join([text_of("MIT", 2), prose(4, 20), text_of("Apache-2.0", 1), text_of("LGPL-3.0"), prose(5, 9),
                     text_of("MIT")])
    assert names(text) == ["MIT", "Apache-2.0", "LGPL-3.0", "MIT"]
    assert names(" ".join([text_of("MIT")] * 300)) == ["MIT"] * 300


def test_clean_texts_have_none():
    assert not any(names(prose(i, 400)) for i in range(40))
    assert names("") == names("license") == names("!? \n") == []
    assert names("The license of the work is under discussion, and the software is free of charge.") == []


def test_search_equals_every_window():
    r = random.Random(5)
    templates = [("a", "one two three four five six"), ("b", "one two three nine five six seven"),
                 ("c", "two two two two three one"), ("d", "four five"), ("e", "seven"), ("f", "")]
    m = license_scan.Matcher(templates, 0.7)
    vocabulary = "one two three four five six seven nine x y".split()
    for _ in range(400):
        words = [r.choice(vocabulary) for _ in range(r.randrange(30))]
        for _ in range(r.randrange(4)):
            t = r.choice(templates)[1].split()
            at = r.randrange(len(words) + 1)
            words[at:at] = [w for w in t if r.random() < 0.9]
        text = " ".join(words)
        assert [tuple(n) for n in m.notices(text)] == plain(text, templates, 0.7)


def test_whole_runs_lose_no_window():
    r = random.Random(6)
    short = [t for t in TEMPLATES if len(t[1]) < 90]
    for name, template in short:
        words = template.split()
        for _ in range(r.randrange(4)):
            words.insert(r.randrange(len(words)), "extra")
        text = " ".join([prose(7, 5), *words, prose(8, 5)])
        one = license_scan.Matcher([(name, template)])
        found, best = one.notices(text), best_dice(text, template)
        assert bool(found) == (best >= license_scan.THRESHOLD)
        assert not found or found[0].dice <= best


def test_chunks_cut_no_word(monkeypatch):
    text = "Größe " + " ".join(t for _, t in TEMPLATES) + prose(9, 300)
    whole = MATCHER.notices(text)
    for size in (1, 7, 64, 1000):
        monkeypatch.setattr(license_scan, "CHUNK", size)
        assert MATCHER.notices(text) == whole


def test_very_long_text():
    text = " ".join([prose(1, 60_000), text_of("MIT", 2), prose(2, 900_000 // 30), "software the " * 50_000])
    assert names(text) == ["MIT"]


def test_scan_of_edge_rows(edge_docs, edge_rows, no_docs):
    rows = license_scan.scan(edge_docs).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r[0] for r in edge_rows)
    assert Counter((r["doc_id"], r["license"], r["dice"], r["licenses"], r["notices"]) for r in rows
                   if r["license"]) == Counter({(14, "MIT", 1.0, "MIT", "MIT:0:5"): 1})
    assert all((r["dice"], r["licenses"], r["notices"]) == (0.0, "", "") for r in rows if not r["license"])
    assert license_scan.scan(no_docs).count() == 0


def test_columns_of_several_notices(spark):
    text = " ".join([text_of("MPL-2.0"), prose(3, 8), text_of("CC0-1.0"), "Released under an MIT License"])
    row = license_scan.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    found = MATCHER.notices(text)
    assert row["license"] == "CC0-1.0" and row["dice"] == 1.0
    assert row["licenses"] == ",".join(sorted({n.license for n in found}))
    assert row["notices"] == ",".join(f"{n.license}:{n.start}:{n.end}" for n in found)

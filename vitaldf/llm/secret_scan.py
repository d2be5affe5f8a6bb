"""Secret scan over a trigram inverted index.

From each rule's regex a Boolean trigram query is derived: the trigrams that
every match must hold.  The index has, for each block of documents and each
trigram that some query uses, the posting list of the block's documents that
hold it (in lower case).  A query intersects and unites posting lists; only
the candidates that it leaves are verified with the regex.  A rule without
mandatory trigrams has every document as candidate, so it scans fully.

All of it is DataFrame functions.  A posting block holds about
``BLOCK_DOCS`` documents however common a trigram is, so no posting list
grows with the corpus.  Trigrams that no query uses would never be read and
are left out of the index.

Nulls and edge cases: a null text counts as empty and has no spans.
Documents are told apart by id and text: repeated rows each get their
result, and a null id is an id like any other.  Spans are in code points,
end exclusive.  Texts and matches may be of any length: no rule bounds a
key's lines or characters, and none makes the matcher recurse over them.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitaldf.llm.common import free_name, n_blocks, saved, text_or_empty

BLOCK_DOCS = 4096
#: a literal part with more alternatives than this is not expanded further
MAX_LITERALS = 64


@dataclass(frozen=True)
class Rule:
    """A kind of secret.  ``value`` is the group whose length must reach ``least``."""

    kind: str
    regex: str
    value: int = 0
    least: int = 1


#: The first three are the base rules; the order is that of equal starts.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                   r"""([A-Za-z0-9+/_.=-]+)""", 2, 12),
    # runs are greedy, so a bound in the regex finds just those long enough
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
    # the header with all up to its END line; without one, with the header lines and the lines of base64
    # (or escaped) that follow it, after which one more word may be taken.  Repeated groups are possessive:
    # Java matches those in a loop, but recurses once a repetition in others, which a long key would overflow
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
                        r"(?:(?:[^-]++|-(?!----(?:BEGIN|END) [A-Z ]*PRIVATE KEY-----))*+"
                        r"-----END [A-Z ]*PRIVATE KEY-----"
                        r"|(?:[ \t\r\n]++[A-Za-z-]++: [^\r\n]*+)*+[ \t\r\n\\]*+"
                        r"[A-Za-z0-9+/\\]{16}[A-Za-z0-9+/=\\\r\n]*+"
                        r"(?:[ \t]++[A-Za-z0-9+/]{16}[A-Za-z0-9+/=\\\r\n]*+)*+"
                        r"(?:[ \t]++[A-Za-z0-9+/=]++(?:[\r\n]|$))?)?"),
    Rule("git_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pay_key", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("map_key", r"AIza[A-Za-z0-9_-]{35}"),
)
BASE_KINDS = ("assign", "access", "hex")


# --- Boolean trigram queries -------------------------------------------------

def _all(parts):
    """AND of queries; True is the query that everything meets."""
    parts = [p for p in dict.fromkeys(parts) if p is not True]
    return True if not parts else parts[0] if len(parts) == 1 else ("and", *parts)


def _any(parts):
    if True in parts:
        return True
    held = {p: set(trigrams_of(p)) for p in parts}
    # among plain conjunctions, one that asks for more than another adds nothing
    plain = [p for p in held if isinstance(p, str) or all(isinstance(q, str) for q in p[1:]) and p[0] == "and"]
    parts = [p for p in held if p not in plain or not any(held[q] < held[p] for q in plain)]
    return parts[0] if len(parts) == 1 else ("or", *parts)


def _literals(words):
    """The query of a text that holds one of ``words``."""
    return _any([_all([w[i:i + 3] for i in range(len(w) - 2)]) for w in sorted(words)])


def _walk(node, parser):
    """(words, query): all texts that ``node`` matches, or None if too many; its query then."""
    op, arg = node
    name = str(op)
    if name == "LITERAL":
        return {chr(arg).lower()}, True
    if name == "IN":
        words = set()
        for kind, x in arg:
            if str(kind) == "LITERAL":
                words.add(chr(x).lower())
            elif str(kind) == "RANGE" and x[1] - x[0] < 8:
                words.update(chr(c).lower() for c in range(x[0], x[1] + 1))
            else:
                return None, True
        return (words, True) if len(words) <= 8 else (None, True)
    if name == "SUBPATTERN":
        return _sequence(arg[3], parser)
    if name == "BRANCH":
        found = [_sequence(x, parser) for x in arg[1]]
        if all(w is not None for w, _ in found):
            return set().union(*(w for w, _ in found)), True
        return None, _any([q if w is None else _literals(w) for w, q in found])
    if name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
        low, high, body = arg
        words, query = _sequence(body, parser)
        if high == 1 and low == 0 and words is not None:
            return words | {""}, True
        if low == high and low <= 4 and words is not None and len(words) ** low <= MAX_LITERALS:
            return {"".join(x) for x in product(words, repeat=low)}, True
        return None, True if low == 0 else query if words is None else _literals(words)
    return (set(("",)), True) if name == "AT" else (None, True)


def _sequence(nodes, parser):
    """As _walk, for a sequence: neighbouring literal parts are joined before trigrams are taken."""
    words, queries, exact = {""}, [], True
    for node in nodes:
        more, query = _walk(node, parser)
        if more is not None and len(words) * len(more) <= MAX_LITERALS:
            words = {a + b for a in words for b in more}
            continue
        exact = False
        queries += [_literals(words), query]
        words = {""} if more is None else more
    return (words, True) if exact else (None, _all([*queries, _literals(words)]))


def trigram_query(regex: str):
    """True, a trigram, or ("and"|"or", query, ...): what a text with a match must meet.

    Trigrams are in lower case, whatever the regex's case, and so over-accept.
    """
    from re import _parser as parser

    words, query = _sequence(parser.parse(regex), parser)
    return query if words is None else _literals(words)


def trigrams_of(query) -> list[str]:
    if query is True:
        return []
    if isinstance(query, str):
        return [query]
    return sorted({t for q in query[1:] for t in trigrams_of(q)})


# --- index and candidates ----------------------------------------------------

def build_index(keyed: DataFrame, vocabulary: list[str], blocks: int) -> DataFrame:
    """(block, trigram, docs): the keys of a block's documents that hold the trigram.

    ``keyed`` has the document key ``key`` (long) and ``text``.
    """
    held = F.filter(F.array(*[F.lit(t) for t in vocabulary]), lambda t: F.contains(F.col("low"), t))
    return (keyed.select("key", F.lower("text").alias("low"))
            .select("key", F.explode(held).alias("trigram"))
            .groupBy(F.pmod("key", F.lit(blocks)).alias("block"), "trigram")
            .agg(F.collect_set("key").alias("docs")))


def _postings(query, lists: Column) -> Column:
    if isinstance(query, str):
        return F.coalesce(F.try_element_at(lists, F.lit(query)), F.array().cast("array<bigint>"))
    merge = F.array_intersect if query[0] == "and" else F.array_union
    found = _postings(query[1], lists)
    for q in query[2:]:
        found = merge(found, _postings(q, lists))
    return found


def candidates(index: DataFrame, rules: list[Rule]) -> DataFrame:
    """(key, kinds): the documents whose posting lists meet the query of a rule."""
    lists = index.groupBy("block").agg(
        F.map_from_entries(F.collect_list(F.struct("trigram", "docs"))).alias("lists"))
    hits = F.array(*[F.struct(F.lit(r.kind).alias("kind"),
                              _postings(trigram_query(r.regex), F.col("lists")).alias("docs"))
                     for r in rules])
    return (lists.select(F.inline(hits)).select("kind", F.explode("docs").alias("key"))
            .groupBy("key").agg(F.collect_set("kind").alias("kinds")))


# --- verification ------------------------------------------------------------

SPANS = "array<struct<start:int,ord:int,kind:string,end:int>>"
#: matches whose positions are added up in one go
STRIDE = 256


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Array of (start, ord, kind, end) of the rule's matches that are long enough.

    ``split`` gives the text between matches, so starts are running sums of
    the lengths of gaps and matches.  They are added up STRIDE matches at a
    time, so that a text with very many matches takes linear time.
    """
    pattern, empty = F.lit(rule.regex), F.array().cast(SPANS)
    parts = F.arrays_zip(
        F.split(text, rule.regex, -1).alias("gap"),
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, pattern, F.lit(rule.value)).alias("value"))

    def step(acc, x):
        begin = acc["at"] + F.length(x["gap"])
        end = begin + F.length(x["hit"])
        one = F.array(F.struct(begin.alias("start"), F.lit(order).alias("ord"),
                               F.lit(rule.kind).alias("kind"), end.alias("end")))
        keep = x["hit"].isNotNull() & (F.length(x["value"]) >= rule.least)
        return F.struct(F.coalesce(end, begin).alias("at"),
                        F.when(keep, F.concat(acc["found"], one)).otherwise(acc["found"]).alias("found"))

    def stride(acc, x):
        found = F.aggregate(x, F.struct(acc["at"].alias("at"), empty.alias("found")), step)
        return F.struct(found["at"].alias("at"),
                        F.concat(acc["found"], F.array(found["found"])).alias("found"))

    def strides(p):  # p is bound to the matches, which are so found only once
        return F.aggregate(
            F.transform(F.sequence(F.lit(0), F.floor((F.size(p) - 1) / STRIDE).cast("int")),
                        lambda i: F.slice(p, i * STRIDE + 1, F.lit(STRIDE))),
            F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPANS}>").alias("found")),
            stride, lambda a: F.flatten(a["found"]))

    return F.when(F.rlike(text, pattern), F.transform(F.array(parts), strides)[0]).otherwise(empty)


def _found(text: Column, rules: tuple[Rule, ...], kinds: Column) -> Column:
    """Spans of the rules in ``kinds`` or without a trigram query, by start and rule."""
    parts = []
    for i, r in enumerate(rules):
        spans = _spans(text, r, i)
        if trigram_query(r.regex) is not True:
            spans = F.when(F.array_contains(kinds, r.kind), spans)
        parts.append(F.coalesce(spans, F.array().cast(SPANS)))
    return F.array_sort(F.concat(*parts))


def scan(docs: DataFrame, out: str = "spans", id_col: str = "doc_id", text_col: str = "text",
         rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with ``out``: array of (start, ord, kind, end), by start and then rule order.

    The candidates are written first, so that their size is known: if small
    they are broadcast and no text is shuffled.
    """
    indexed = [r for r in rules if trigram_query(r.regex) is not True]
    vocabulary = sorted({t for r in indexed for t in trigrams_of(trigram_query(r.regex))})
    key, kinds, text = free_name(docs, "key"), free_name(docs, "kinds"), text_or_empty(text_col)
    own_key = F.xxhash64(F.col(f"`{id_col}`"), text)
    index = build_index(docs.select(own_key.alias("key"), text.alias("text")), vocabulary,
                        n_blocks(docs.count(), BLOCK_DOCS))
    hits = saved(candidates(index, indexed).toDF(key, kinds), "candidates")
    return docs.withColumn(key, own_key).join(hits, key, "left").select(
        *[F.col(f"`{c}`") for c in docs.columns], _found(text, rules, F.col(kinds)).alias(out))


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """``text`` with every span (overlapping ones as one) replaced by ``mask``."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))

    def step(acc, s):
        apart = s["start"] >= acc["at"]
        piece = F.concat(acc["done"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mask))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(apart, piece).otherwise(acc["done"]).alias("done"))

    return F.aggregate(spans, start, step, lambda a: F.concat(
        a["done"], F.substring(text, a["at"] + 1, F.length(text))))


def mask_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with the secrets in ``text_col`` masked; a null text stays null."""
    spans, text = free_name(docs, "spans"), F.col(f"`{text_col}`")
    clean = F.when(F.size(spans) > 0, masked(text, F.col(spans))).otherwise(text)
    return (scan(docs, spans, id_col, text_col, rules).withColumn(text_col, clean)
            .select(*[F.col(f"`{c}`") for c in docs.columns]))

"""Public licences' texts, and the notices by which they are granted.

``TEMPLATES`` holds (SPDX name, text) pairs.  Short licences stand as whole
texts; of the long ones, the passage that opens them.  Names of authors,
years and holders are left out.
"""

from __future__ import annotations

_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
    "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
    "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
    "subject to the following conditions:",
    "The above copyright notice and this permission notice shall be included in all copies or substantial "
    "portions of the Software.",
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
    "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN "
    "NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
    "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
    "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")

_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met:",
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
    "promote products derived from this software without specific prior written permission.",
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR "
    "ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
    "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
    "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
    "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF "
    "ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")

_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
    "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE "
    "FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS "
    "OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING "
    "OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")

#: the licence, its name, version, and how its own text opens after name and version
_GNU = (
    ("AGPL-3.0", "GNU Affero General Public License", "3", "19 November 2007 Copyright (C) 2007"),
    ("GPL-2.0", "GNU General Public License", "2", "June 1991 Copyright (C) 1989, 1991"),
    ("GPL-3.0", "GNU General Public License", "3", "29 June 2007 Copyright (C) 2007"),
    ("LGPL-2.1", "GNU Lesser General Public License", "2.1", "February 1999 Copyright (C) 1991, 1999"),
    ("LGPL-3.0", "GNU Lesser General Public License", "3", "29 June 2007 Copyright (C) 2007"),
)

#: the licence's letters, and its name
_CREATIVE_COMMONS = (
    ("BY", "Attribution"),
    ("BY-NC", "Attribution-NonCommercial"),
    ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
    ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    ("BY-ND", "Attribution-NoDerivatives"),
    ("BY-SA", "Attribution-ShareAlike"),
)


def _gnu() -> list[tuple[str, str]]:
    rows = []
    for spdx, name, version, opening in _GNU:
        rows += [
            (spdx, f"This work is licensed under the {name}, version {version}."),
            (spdx, f"This program is free software: you can redistribute it and/or modify it under the terms of "
                   f"the {name} as published by the Free Software Foundation, either version {version} of the "
                   f"License, or (at your option) any later version."),
            (spdx, f"{name} Version {version}, {opening} Free Software Foundation, Inc. Everyone is permitted "
                   f"to copy and distribute verbatim copies of this license document, but changing it is not "
                   f"allowed.")]
    return rows


def _creative_commons() -> list[tuple[str, str]]:
    rows = []
    for letters, name in _CREATIVE_COMMONS:
        for version, scope in (("3.0", "Unported"), ("4.0", "International")):
            spdx, full = f"CC-{letters}-{version}", f"Creative Commons {name} {version} {scope} License"
            rows += [(spdx, f"This work is licensed under a {full}."),
                     (spdx, f"Licensed under the {full}."),
                     (spdx, f"Licensed under CC {letters} {version}.")]
    return rows


TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
     "except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND "
     "CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("BSD-2-Clause", " ".join([*_BSD[:3], _BSD[4]])),
    ("BSD-3-Clause", " ".join(_BSD)),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the "
     "LICENSE file."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or "
     "neighboring rights to this work."),
    ("ISC", _ISC[0]),
    ("ISC", " ".join(_ISC)),
    ("MIT", "Released under the MIT License."),
    ("MIT", _MIT[0]),
    ("MIT", " ".join(_MIT)),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "Mozilla Public License Version 2.0 1. Definitions 1.1. \"Contributor\" means each individual or "
     "legal entity that creates, contributes to the creation of, or owns Covered Software."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    *_creative_commons(),
    *_gnu(),
)

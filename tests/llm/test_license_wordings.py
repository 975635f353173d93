"""Whole license wordings are accepted, and no wording with a word changed, left out or added."""

from __future__ import annotations

import pyarrow as pa
import pytest

from martloom.llm import license_scan

ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
CONDITIONS = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

{0}Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
{1}Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
"""
NAMES = """{2}Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.
"""
DISCLAIMER = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT
SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING
NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
WHOLE = {
    "ISC": [ISC, ISC.replace("and/or", "and").replace("THE AUTHOR", "Some Person And Others")],
    "BSD-2-Clause": [CONDITIONS.format("1. ", "2. ") + DISCLAIMER, CONDITIONS.format("* ", "* ") + DISCLAIMER],
    "BSD-3-Clause": [(CONDITIONS + NAMES).format("1. ", "2. ", "3. ") + DISCLAIMER, (CONDITIONS + NAMES).format("", "", "") + DISCLAIMER],
}


def labels(*texts: str) -> list[str]:
    return license_scan.scan_texts(pa.array(texts))[5].to_pylist()


@pytest.mark.parametrize("label", WHOLE)
def test_whole_wordings(label):
    for text in WHOLE[label]:
        assert labels(text, f"Copyright 2001 Someone\n\n{text}\nand more", text.lower(), text.replace("\n", "  ")) == [label] * 4


@pytest.mark.parametrize("label", WHOLE)
def test_no_word_may_be_missing_changed_or_added(label):
    words = WHOLE[label][0].split()
    free = {k for k, w in enumerate(words) if w in ("1.", "2.", "3.", "and/or")}
    free |= {k for k, w in enumerate(words) if {"AUTHOR", "COPYRIGHT", "HOLDER", "HOLDERS", "CONTRIBUTORS", "copyright", "holder"} & {w, words[k - 1]}}
    free |= {k for k in range(len(words)) if words[k] in ("THE", "BY", "SHALL", "AND", "OR", "the")}
    changed = [" ".join([*words[:k], *new, *words[k + 1 :]]) for k in range(1, len(words) - 1) if k not in free for new in ([], ["zebra"])]
    added = [" ".join([*words[:k], "unless", *words[k:]]) for k in (20, len(words) - 5)]
    found = labels(*changed, *[a for a in added if "by unless" not in a.lower()])
    assert len(changed) > 100 and label not in found


def test_an_opening_with_another_end_is_refused():
    opening = ISC.split("\n\n")[0]
    assert labels(opening + " unless you are a company, which must pay", opening) == ["", ""]
    altered = DISCLAIMER.replace("ARE DISCLAIMED", "ARE GRANTED")
    assert labels(CONDITIONS.format("1. ", "2. ") + altered, CONDITIONS.format("1. ", "2. ")) == ["", ""]

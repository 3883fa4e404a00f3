"""License scan: digests of canonical texts against those of known licences.

A text is made canonical (copyright lines out, lower case, equivalent spellings made one, everything but
letters and digits one space) and its SHA-256 looked up among the digests of known licence texts and
notices, made canonical the same way. Looked up are whole documents and each of their lines.
"""

from __future__ import annotations

import pkgutil
import re
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Texts that state a licence, as their publishers word them.
_STATED = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-3.0-or-later", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("GPL-2.0-only", "SPDX-License-Identifier: GPL-2.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    (
        "MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "ISC",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ),
    (
        "0BSD",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ),
    (
        "BSD-2-Clause",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    ),
    (
        "BSD-3-Clause",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    ),
)

#: Titles that a licence's text may stand under.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "License: MIT"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)", "ISC License (ISCL)", "The ISC License (ISC)"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "Zero-Clause BSD License", "BSD Zero Clause License (0BSD)", "0BSD License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", 'BSD 2-Clause "Simplified" License', "Simplified BSD License", "BSD License", "The BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License', "New BSD License", "Modified BSD License", "BSD License", "The BSD License"),
}
#: Licences whose whole text is a file of ``license_texts``; what follows these words is an appendix.
LONG, APPENDIX = ("Apache-2.0", "GPL-2.0", "GPL-3.0", "MPL-2.0", "CC0-1.0"), "END OF TERMS AND CONDITIONS"


def _whole_texts() -> Iterator[tuple[str, str]]:
    """Whole texts beside those stated above: under a title, a line on rights or both, and with or without appendix."""
    for name, text in _STATED:
        if len(text) > 500:
            for title in ("", *TITLES[name]):
                for rights in ("", "All rights reserved."):
                    if title or rights:
                        yield name, "\n\n".join(t for t in (title, rights, text) if t)
    for name in LONG:
        text = pkgutil.get_data(__package__, f"license_texts/{name}.txt").decode()
        terms, found, _ = text.partition(APPENDIX)
        for part in (text, *((terms, terms + found) if found else ())):
            yield name, part
            # a paragraph a line: a wrapped line that begins with "copyright" goes from the one, not from the other
            yield name, re.sub(r"(?<!\n)\n(?!\n)", " ", part)


KNOWN = (*_STATED, *_whole_texts())

# Spellings that licence matching treats as one.
SPELLINGS = (
    ("licenc", "licens"),
    ("sub-licens", "sublicens"),
    ("sub licens", "sublicens"),
    ("non-commercial", "noncommercial"),
    ("non-infringement", "noninfringement"),
    ("share-alike", "sharealike"),
    ("organis", "organiz"),
    ("authoris", "authoriz"),
    ("recognis", "recogniz"),
    ("acknowledgement", "acknowledgment"),
    ("favour", "favor"),
    ("fulfil ", "fulfill "),
    ("whilst", "while"),
    ("wilful", "willful"),
    ("per cent", "percent"),
    ("copyright owner", "copyright holder"),
    ("https://", "http://"),
    ("&", " and "),
)
COPYRIGHT_LINE = r"(^|\n)[ \t]*(copyright |\(c\) |©)[^\n]*"


# Every known canonical text has one of these, and so has, in lower case, every text that becomes one (the
# first five letters of "licence" are the same in both spellings, and no other spelling touches them).
MARKS = ("licen", "permission", "redistribution")


def canonical(text: Column) -> Column:
    """Lower case without copyright lines, equivalent spellings made one, other than a-z and 0-9 one space."""
    return _canonical_lower(F.lower(text))


def _canonical_lower(text: Column) -> Column:
    text = F.regexp_replace(text, COPYRIGHT_LINE, "\n")
    text = reduce(lambda t, pair: F.replace(t, F.lit(pair[0]), F.lit(pair[1])), SPELLINGS, text)
    return F.trim(F.regexp_replace(text, "[^a-z0-9]+", " "))


def _marked(lower: Column, marks: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(lower, F.lit(m)) for m in marks)) if marks else F.lit(True)


def known_digests(spark: SparkSession, known=KNOWN) -> DataFrame:
    """``(digest, license_id)`` of the known texts; a digest has one licence, the first by name."""
    rows = spark.createDataFrame(list(known), "license_id string, text string")
    return rows.select("license_id", F.sha2(canonical(F.col("text")), 256).alias("digest")).groupBy("digest").agg(F.min("license_id").alias("license_id"))


def license_hits(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", marks: tuple[str, ...] = ()) -> DataFrame:
    """``(id, license_id, scope, n_found)``: licences whose text a document or a line of it is.

    ``scope`` is ``document`` for the whole text, else ``line``; a text of one line is looked up as a
    document only. ``known`` has ``digest`` and ``license_id`` (the package's own list by default); Spark chooses
    how to join it. ``marks`` may name words in lower case of which each text that becomes a known one has one; only texts and lines that have
    one are made canonical (once each, before they are rows). Null and empty texts, and texts with nothing left when canonical, have no
    licence. Rows with the same id (null ids are one) are counted together. Other columns are not looked at.
    """
    if known is None:
        known, marks = known_digests(docs.sparkSession), MARKS
    text = F.lower(F.col(text_col).cast("string"))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text")).where(F.col("text").isNotNull() & _marked(F.col("text"), marks))
    unit = lambda scope, x: F.struct(F.lit(scope).alias("scope"), F.sha2(_canonical_lower(x), 256).alias("digest"))
    lines = F.when(F.instr("text", "\n") > 0, F.filter(F.split("text", "\n"), lambda x: _marked(x, marks))).otherwise(F.array())
    units = F.concat(F.array(unit("document", F.col("text"))), F.transform(lines, lambda x: unit("line", x)))
    rows = rows.select("id", F.explode(units).alias("u")).select("id", "u.scope", "u.digest")
    hits = rows.where(F.col("digest") != F.sha2(F.lit("").cast("binary"), 256)).join(known, "digest")
    return hits.groupBy("id", "license_id", "scope").agg(F.count(F.lit(1)).alias("n_found"))

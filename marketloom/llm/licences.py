"""Whole texts matched against known licences by a canonical digest.

Case, punctuation, copyright lines and spellings that count as equivalent are normalised,
the rest is hashed, and the digest is joined to the digests of the known licences.
Everything is a built-in expression; the only shuffle-free join is against the licence
table, whose rows are the handful listed here.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Spellings that count as equivalent, each replaced by the second.
SPELLINGS = [
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sublicence", "sublicense"),
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("calibre", "caliber"), ("cancelled", "canceled"),
    ("favour", "favor"), ("fulfil", "fulfill"), ("merchantibility", "merchantability"), ("organisation", "organization"),
    ("percent", "per cent"), ("sub license", "sublicense"), ("copyright owner", "copyright holder"),
]

# Full texts of short licences, as published.
KNOWN = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSL-1.0": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:
The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "Unlicense": """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
For more information, please refer to <https://unlicense.org>""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
    "WTFPL": """DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE
Version 2, December 2004
Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed.
DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE
TERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION
0. You just DO WHAT THE FUCK YOU WANT TO.""",
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
}

# Licences that differ from one above by a clause.
_FREE, _AS_IS = KNOWN["MIT"].split("\n")[0], KNOWN["MIT"].split("\n")[2]
KNOWN["MIT-0"] = _FREE.replace(", subject to the following conditions:", ".") + "\n" + _AS_IS
KNOWN["X11"] = KNOWN["MIT"].replace("THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE", "THE X CONSORTIUM BE LIABLE") + (
    "\nExcept as contained in this notice, the name of the X Consortium shall not be used in advertising or otherwise to promote the sale, use or other dealings in this Software without prior written authorization from the X Consortium.")
_NAMES = "{} Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\nTHIS SOFTWARE IS PROVIDED BY"
KNOWN["BSD-3-Clause"] = KNOWN["BSD-2-Clause"].replace("THIS SOFTWARE IS PROVIDED BY", _NAMES.format("3."))
#: The same texts as they are also published: without numbers or with stars before the clauses, with "and" for "and/or".
VARIANTS = {
    "BSD-2-Clause": [KNOWN["BSD-2-Clause"].replace("\n1. ", "\n* ").replace("\n2. ", "\n* ")],
    "BSD-3-Clause": [KNOWN["BSD-3-Clause"].replace("\n1. ", "\n* ").replace("\n2. ", "\n* ").replace("\n3. ", "\n* ")],
    "ISC": [KNOWN["ISC"].replace("and/or distribute", "and distribute")],
}

#: A line that states a copyright, reserves all rights or is a licence's title, and no more, wherever it begins, so that runs of any length go: the
#: break before a line is not part of the match. The permission text's own "copyright notice" lines do not begin so.
NOTICE = (r"^[ \t#/*;-]*(?:copyright[ \t]*(?:\(c\)|©)[^\n]*|(?:copyright|©|\(c\))[ \t]*(?:[0-9][^\n]*|by [^\n]*)?|all rights reserved[ .]*"
          r"|(?:the )?(?:mit|isc|x11|zlib|bsd[ -]2-clause|bsd[ -]3-clause|bsd zero clause|boost software|mit no attribution)(?: \"[a-z ]+\"| license| licence| \(mit\)| - version [0-9.]+ - august 17th, 2003)*[ .:]*)(?:\n|\z)")
NOTICE_LINES, SQL_NOTICE_LINES = "(?md)" + NOTICE, "(?m)" + NOTICE
#: Each alternative of NOTICE holds one of these, wherever its line begins.
IN_NOTICES = ("copyright", "©", "(c)", "all rights", "mit", "isc", "x11", "zlib", "bsd", "boost software")
#: Letters, digits and whatever lies beyond Latin-1 punctuation stay; curly quotes, dashes and ellipses go.
NOT_WORD = r"[^a-z0-9\x{C0}-\x{1FFF}\x{2070}-\x{2FFF}\x{3040}-\x{10FFFF}]+"


def with_canonical(df: DataFrame, text: str, out: str) -> DataFrame:
    """df with the canonical form of `text` in `out`: words in lower case, one space apart.

    The two letters whose lower case depends on more than themselves are replaced first.
    Copyright and title lines are removed however many are adjacent. Each step that is used more than
    once is a column of its own, so that it runs once a row.
    """
    low = F.lower(F.replace(F.replace(F.coalesce(F.col(text), F.lit("")), F.lit("İ"), F.lit("i")), F.lit("Σ"), F.lit("σ")))
    held = F.col("_low")
    stripped = F.regexp_replace(held, NOTICE_LINES, "")
    # every match of the pattern has one of these in it, and a search by bytes is far cheaper than a pattern over the whole text
    mentions = reduce(Column.__or__, [held.contains(x) for x in IN_NOTICES])
    words = F.concat(F.lit(" "), F.regexp_replace(F.when(mentions, stripped).otherwise(held), NOT_WORD, " "), F.lit(" "))
    for old, new in SPELLINGS:
        words = F.replace(words, F.lit(f" {old} "), F.lit(f" {new} "))
    return df.withColumn("_low", F.replace(low, F.lit("\r"), F.lit("\n"))).withColumn(out, F.trim(words)).drop("_low")


def known_texts() -> list[tuple[str, str]]:
    return sorted([*KNOWN.items(), *((name, text) for name, texts in VARIANTS.items() for text in texts)])


def known_digests(spark: SparkSession) -> DataFrame:
    """license_id, license_digest: one row for each text of KNOWN and VARIANTS."""
    frame = spark.createDataFrame(known_texts(), "license_id string, body string")
    return with_canonical(frame, "body", "_words").select("license_id", F.sha2("_words", 256).alias("license_digest"))


def match_licences(docs: DataFrame, text: str = "text", known: DataFrame | None = None) -> DataFrame:
    """docs' rows (all columns) with canonical_digest and license_id (null if unknown).

    A null text counts as empty, and an empty canonical form matches nothing. Two known
    licences with one canonical form would both match, giving two rows; those kept here have none, which a test holds. The
    licence table is broadcast, as it is a constant of this module; a table given as `known`
    is joined by hash, at whatever size. Columns `_low`, `_words`, `canonical_digest` and
    `license_id` of docs are replaced; an empty table gives no rows.
    """
    own = docs.drop("canonical_digest", "license_id")
    digested = with_canonical(own, text, "_words").withColumn("canonical_digest", F.sha2("_words", 256)).drop("_words")
    given = known if known is not None else F.broadcast(known_digests(docs.sparkSession))
    return digested.join(given.withColumnRenamed("license_digest", "canonical_digest"), "canonical_digest", "left")


def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sql_canonical(text: str) -> str:
    out = f"replace(lower(replace(replace(coalesce({text}, ''), 'İ', 'i'), 'Σ', 'σ')), chr(13), chr(10))"
    line = f"regexp_replace({out}, {_sql_text(SQL_NOTICE_LINES)}, '', 'g')"  # of every text, without the search before it
    out = f"(' ' || regexp_replace({line}, {_sql_text(NOT_WORD)}, ' ', 'g') || ' ')"
    for old, new in SPELLINGS:
        out = f"replace({out}, ' {old} ', ' {new} ')"
    return f"trim({out})"


def oracle() -> str:
    known = ", ".join(f"({_sql_text(k)}, {_sql_text(v)})" for k, v in known_texts())
    return f"""
WITH known AS (SELECT license_id, sha256({_sql_canonical('body')}) AS license_digest FROM (VALUES {known}) AS v(license_id, body)),
digested AS (SELECT doc_id, sha256({_sql_canonical('text')}) AS canonical_digest FROM documents)
SELECT doc_id, canonical_digest, license_id FROM digested LEFT JOIN known ON license_digest = canonical_digest
"""

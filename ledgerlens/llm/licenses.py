"""Licence scans: sentences to known licence-sentence identifiers, then identifier sequences against ordered rules."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import map_rows, table

#: The wording of licences. Sentence -> identifier. A sentence is normalised: lower case, every stretch of
#: other than letters and digits a blank.
SENTENCES = {
    "licensed under the apache license version 2 0": "Apache2Line",
    "this work is licensed under the gnu general public license version 3": "GPL3Line",
    "released under the mit license": "MITLine",
    "licensed under cc by nc 4 0": "CCBYNC4Line",
    "licensed under the apache license version 2 0 the license": "Apache2Grant",
    "you may not use this file except in compliance with the license": "Apache2Comply",
    "you may obtain a copy of the license at": "Apache2Copy",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "Apache2AsIs",
    "see the license for the specific language governing permissions and limitations under the license": "Apache2See",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "MITGrant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "MITNotice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "MITAsIs",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "MITLiable",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "BSDGrant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "BSDSource",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "BSDBinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BSDNames",
    "neither the name of the author nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BSDNames",
    "neither the name of the university nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BSDNames",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "BSDAsIs",
    "in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage": "BSDLiable",
    "in no event shall the copyright owner or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage": "BSDLiable",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "ISCGrant",
    "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "ISCGrant",
    "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness": "ISCAsIs",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "MPL2Grant",
    "if a copy of the mpl was not distributed with this file you can obtain one at": "MPL2Copy",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "GPLAsIs",
    "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "GPLAsIs",
    "see the gnu general public license for more details": "GPLSee",
    "see the gnu lesser general public license for more details": "GPLSee",
    "see the gnu affero general public license for more details": "GPLSee",
    "you should have received a copy of the gnu general public license along with this program": "GPLCopy",
    "if not see": "GPLIfNot",
    "this work is licensed under a creative commons attribution 4 0 international license": "CCBY4Line",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license": "CCBYSA4Line",
    "this work is licensed under the creative commons attribution 4 0 international license": "CCBY4Line",
    "this work is licensed under the creative commons attribution sharealike 4 0 international license": "CCBYSA4Line",
    "licensed under cc by 4 0": "CCBY4Line",
    "licensed under cc by sa 4 0": "CCBYSA4Line",
    "this is free and unencumbered software released into the public domain": "UnlicenseGrant",
}
#: The grants of the GNU licences: identifier, kind of work, licence's name, version, licence.
for _id, _work, _name, _version in [
    (f"{short}{version.replace(' ', '')}Grant", work, name, version)
    for short, name, versions in (("GPL", "general", ("2", "3")), ("LGPL", "lesser general", ("2 1", "3")), ("AGPL", "affero general", ("3",)))
    for version in versions
    for work in ("program", "library")
]:
    SENTENCES[f"this {_work} is free software you can redistribute it and or modify it under the terms of the gnu {_name} public license as published by the free software foundation either version {_version} of the license or at your option any later version"] = _id
#: Identifiers of the SPDX list that a line can name.
SPDX = ["MIT", "Apache-2.0", "ISC", "MPL-2.0", "BSD-2-Clause", "BSD-3-Clause", "Unlicense", "Zlib", "BSL-1.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", *(f"{name}-{kind}" for name in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0") for kind in ("only", "or-later"))]
SENTENCES |= {"spdx license identifier " + re.sub("[^a-z0-9]+", " ", name.lower()): f"SPDX:{name}" for name in SPDX}
#: Ordered rules: the first sequence that starts at a sentence wins and uses its sentences up.
RULES = [
    (("Apache2Grant", "Apache2Comply", "Apache2Copy", "Apache2AsIs", "Apache2See"), "Apache-2.0"),
    (("Apache2Grant", "Apache2Comply"), "Apache-2.0"),
    (("MITGrant", "MITNotice", "MITAsIs", "MITLiable"), "MIT"),
    (("MITGrant", "MITNotice", "MITAsIs"), "MIT"),
    (("MITGrant", "MITNotice"), "MIT"),
    (("BSDGrant", "BSDSource", "BSDBinary", "BSDNames", "BSDAsIs", "BSDLiable"), "BSD-3-Clause"),
    (("BSDGrant", "BSDSource", "BSDBinary", "BSDNames", "BSDAsIs"), "BSD-3-Clause"),
    (("BSDGrant", "BSDSource", "BSDBinary", "BSDNames"), "BSD-3-Clause"),
    (("BSDGrant", "BSDSource", "BSDBinary", "BSDAsIs", "BSDLiable"), "BSD-2-Clause"),
    (("BSDGrant", "BSDSource", "BSDBinary", "BSDAsIs"), "BSD-2-Clause"),
    (("BSDGrant", "BSDSource", "BSDBinary"), "BSD-2-Clause"),
    (("ISCGrant", "ISCAsIs"), "ISC"),
    (("ISCGrant",), "ISC"),
    (("MPL2Grant", "MPL2Copy"), "MPL-2.0"),
    (("MPL2Grant",), "MPL-2.0"),
    *(
        ((f"{short}Grant", *rest), licence)
        for short, licence in (("GPL3", "GPL-3.0-or-later"), ("GPL2", "GPL-2.0-or-later"), ("LGPL21", "LGPL-2.1-or-later"), ("LGPL3", "LGPL-3.0-or-later"), ("AGPL3", "AGPL-3.0-or-later"))
        for rest in (("GPLAsIs", "GPLSee", "GPLCopy", "GPLIfNot"), ("GPLAsIs", "GPLSee", "GPLCopy"), ("GPLAsIs", "GPLSee"), ("GPLAsIs",), ())
    ),
    (("Apache2Line",), "Apache-2.0"),
    (("GPL3Line",), "GPL-3.0"),
    (("MITLine",), "MIT"),
    (("CCBYNC4Line",), "CC-BY-NC-4.0"),
    (("CCBY4Line",), "CC-BY-4.0"),
    (("CCBYSA4Line",), "CC-BY-SA-4.0"),
    (("UnlicenseGrant",), "Unlicense"),
    *(((f"SPDX:{name}",), name) for name in SPDX),
]
#: Sentences too plain to be reported where no rule takes them.
PLAIN = {"GPLIfNot"}
#: The longest word of each sentence: a text without any of these holds no sentence.
HINT = re.compile("|".join(sorted({max(x.split(), key=len) for x in SENTENCES})))
COPYRIGHT = re.compile(r"(?:copyright|c) (?:c )?(?:[0-9]{4} )+|copyright c\b|all rights reserved\Z", re.ASCII)
END = re.compile(r"(?<=[.!?;:])\s+|\n| ?https?://\S+", re.IGNORECASE)
OTHER = re.compile(r"[^a-z0-9]+")
STOP = re.compile(r"(?<!\b[vV])[.!?][^\w.!?]*\Z")  # not the one of "v. 2"
NUMBER = re.compile(r"[\W_]*(?:[0-9]{1,2}|[a-z]|[ivx]{2,4})[.)](?:\s+|\Z)", re.ASCII | re.IGNORECASE)
#: Every first n words of a known sentence.
BEGINNINGS = {" ".join(words[:n]) for words in map(str.split, SENTENCES) for n in range(1, len(words) + 1)}


def _parts(text: str) -> list[tuple[str, int, int]]:
    """(normalised text, start, end) of the pieces between sentence ends, colons, semicolons, links and line ends."""
    out: list[tuple[str, int, int]] = []
    at = 0
    for end, after in [*((m.start(), m.end()) for m in END.finditer(text)), (len(text), len(text))]:
        plain = OTHER.sub(" ", text[at:end].lower()).strip()
        if plain:
            out.append((plain, at, end))
        at = after
    return out


def _known(text: str, parts: list[tuple[str, int, int]], k: int, plain: str) -> tuple[str, int]:
    """(identifier, last piece) of the longest known sentence from piece k, which reads plain; identifier empty if none.

    A sentence may go on over colons, semicolons and wrapped lines, but not over a full stop.
    """
    found, last = "", k
    while plain in BEGINNINGS:
        if plain in SENTENCES:
            found, last = SENTENCES[plain], k
        if k + 1 == len(parts) or STOP.search(text, parts[k][1], parts[k][2]):
            break
        k += 1
        plain += " " + parts[k][0]
    return found, last


def sentence_ids(text: str) -> list[tuple[str, int, int]]:
    """(identifier, start, end) of known sentences and of stretches of unknown ones (identifier empty), in order.

    List numbers before sentences don't count as sentences, nor do copyright lines between them.
    """
    out: list[tuple[str, int, int]] = []
    parts, k = _parts(text), 0
    while k < len(parts):
        plain, start, end = parts[k]
        found, last = _known(text, parts, k, plain)
        if not found and (number := NUMBER.match(text, start, end)):
            if number.end() == end:
                k += 1
                continue
            found, last = _known(text, parts, k, OTHER.sub(" ", text[number.end() : end].lower()).strip())
            start = number.end() if found else start
        if found or ((not out or out[-1][0]) and not COPYRIGHT.match(plain)):
            out.append((found, start, parts[last][2]))
        k = last + 1
    return out


def scan(text: str) -> list[tuple[str, int, int]]:
    """(licence, start, end), in order; known sentences that no rule takes give (unknown, start, end)."""
    if not HINT.search(text.lower()):
        return []
    ids, out, at = sentence_ids(text), [], 0
    while at < len(ids):
        for sequence, licence in RULES:
            if tuple(i for i, _, _ in ids[at : at + len(sequence)]) == sequence:
                out.append((licence, ids[at][1], ids[at + len(sequence) - 1][2]))
                at += len(sequence)
                break
        else:
            if ids[at][0] and ids[at][0] not in PLAIN:
                out.append(("unknown", ids[at][1], ids[at][2]))
            at += 1
    return out


def scan_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of docs: id, licenses (distinct, sorted), n_found, spans (in order; characters).

    Null and empty texts have none; repeated rows and null ids give their own rows; other columns are ignored. Of rules
    that begin with the same sentences the first one given wins, and a sentence counts for one rule alone. A sentence
    that no rule takes counts as `unknown`. A text of any length is read once, a piece of a sentence at a time.
    """

    def make():
        def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = scan(text.as_py() or "")
                yield doc, sorted({x for x, _, _ in found}), len(found), [{"license": x, "start": a, "end": b} for x, a, b in found]

        return rows

    span = pa.struct([("license", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    schema = pa.schema([(id_column, pa.int64()), ("licenses", pa.list_(pa.string())), ("n_found", pa.int64()), ("spans", pa.list_(span))])
    return map_rows(docs.select(F.col(id_column).cast("long"), F.col(text_column).cast("string")), make, schema, f"{id_column} long, licenses array<string>, n_found long, spans array<struct<license:string,start:int,end:int>>")


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan_documents(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.array_join("licenses", ",").alias("licenses"), "n_found")


_LINES = [(text, licence) for sequence, licence in RULES if len(sequence) == 1 for text, i in SENTENCES.items() if (i,) == sequence and not i.endswith("Grant")]
#: The rules of one identifier whose sentence is one line, which are those the tables hold; the tests have the sequences.
OP10_SQL = (
    r"""
WITH s AS (SELECT doc_id, row_number() OVER () AS rid, regexp_replace(coalesce(text, ''), '(spdx-license-identifier):\s*', '\1 ', 'gi') AS text FROM documents),
p AS (SELECT rid, unnest(string_split(regexp_replace(text, '([.!?;:])\s+', '\1' || chr(10), 'g'), chr(10))) AS line FROM s),
n AS (SELECT rid, trim(regexp_replace(lower(line), '[^a-z0-9]+', ' ', 'g')) AS line FROM p),
k(line, license) AS (VALUES """
    + ", ".join(f"('{text}', '{licence}')" for text, licence in _LINES)
    + r"""),
f AS (SELECT rid, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses, count(*) AS n FROM n JOIN k USING (line) GROUP BY rid)
SELECT doc_id, coalesce(licenses, '') AS licenses, CAST(coalesce(n, 0) AS BIGINT) AS n_found FROM s LEFT JOIN f USING (rid)
"""
)

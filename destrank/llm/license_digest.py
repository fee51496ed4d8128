"""Licence scan by canonical digests: DataFrame functions only.

A text is brought to a canonical form (lower case, copyright lines out, every
run of punctuation or white space a separator, equivalent spellings made
equal) and its SHA-256 is joined to the digests of known licences. The join
is made for the entire text of every document, and in the same way for each
of its lines, since a licence notice is often a line of a longer text.

The known licences are one small table (``KNOWN``, or any table given); it is
broadcast only if its counted rows are at most ``BROADCAST_ROWS``, otherwise
Spark joins it by shuffle. Documents are never shuffled or gathered.

Defined cases: a null text has a null digest and no licence; an empty text has
the digest of the empty canonical form; repeated rows give repeated results;
extra columns are ignored; an empty table gives an empty result. Known texts
that share a digest give one result each.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

BROADCAST_ROWS = 100_000

# Spellings that licence matching treats as equal (left: as
# written, right: canonical). Words, or phrases of canonical words.
EQUIVALENT = (
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("cancelled", "canceled"),
    ("catalogue", "catalog"), ("centre", "center"), ("emphasised", "emphasized"), ("favour", "favor"),
    ("favourite", "favorite"), ("fulfil", "fulfill"), ("fulfilment", "fulfillment"), ("initialise", "initialize"),
    ("judgement", "judgment"), ("labour", "labor"), ("licence", "license"), ("licences", "licenses"),
    ("licenced", "licensed"), ("maximise", "maximize"), ("modelled", "modeled"), ("modelling", "modeling"),
    ("offence", "offense"), ("optimise", "optimize"), ("organisation", "organization"),
    ("organisations", "organizations"), ("organise", "organize"), ("practise", "practice"),
    ("programme", "program"), ("realise", "realize"), ("recognise", "recognize"), ("signalling", "signaling"),
    ("sublicence", "sublicense"), ("sub  license", "sublicense"), ("utilisation", "utilization"),
    ("whilst", "while"), ("wilful", "willful"), ("non  commercial", "noncommercial"), ("per  cent", "percent"),
    ("copyright  owner", "copyright  holder"),
)

_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies."""
_ISC_DISCLAIMER = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""

# Licence texts and one-line notices (identifier, text).
KNOWN = (
    ("MIT", _MIT_GRANT),
    ("MIT", "MIT License\n\n" + _MIT_GRANT),
    ("MIT", "The MIT License (MIT)\n\n" + _MIT_GRANT),
    ("ISC", _ISC_GRANT + "\n\n" + _ISC_DISCLAIMER),
    ("ISC", "ISC License\n\n" + _ISC_GRANT + "\n\n" + _ISC_DISCLAIMER),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
     "hereby granted.\n\n" + _ISC_DISCLAIMER),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
)

#: A line that names a copyright holder: its first word says so and a year or sign follows.
COPYRIGHT_LINE = r"\n[^\p{L}\p{N}\n(©]*(?:(?:copyright|©|\(c\))[^\n]*(?:[0-9]{4}|©|\(c\))|©|\(c\)|all rights reserved)[^\n]*"
SEPARATOR = r"[^\p{L}\p{N}]+"


def canonical(text: Column) -> Column:
    """The canonical form: words between double spaces, so that equal
    neighbours do not share a separator when spellings are replaced."""
    out = F.regexp_replace(F.concat(F.lit("\n"), F.lower(text)), COPYRIGHT_LINE, "\n")
    out = F.regexp_replace(F.concat(F.lit(" "), out, F.lit(" ")), SEPARATOR, "  ")
    some = f" (?:{'|'.join(re.escape(written) for written, _ in EQUIVALENT)}) "

    def respelled(words: Column) -> Column:
        usually = words
        for written, usual in EQUIVALENT:
            usually = F.replace(usually, F.lit(f" {written} "), F.lit(f" {usual} "))
        return F.when(words.rlike(some), usually).otherwise(words)  # one search instead of one for each spelling

    return F.trim(F.get(F.transform(F.array(out), respelled), F.lit(0)))


def canonical_digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_licences(spark: SparkSession, known: tuple[tuple[str, str], ...] = KNOWN) -> DataFrame:
    """(license_id, digest) of the given licence texts."""
    rows = F.array(*[F.struct(F.lit(k).alias("license_id"), F.lit(t).alias("text")) for k, t in known])
    one = spark.range(1).select(F.explode(rows).alias("r")).select("r.*")
    return one.select("license_id", canonical_digest(F.col("text")).alias("digest")).distinct()


def scan_licences(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document with its text's digest and licence, if known, and
    one row per line that is a known notice: (id, unit, line_no, digest, license_id)."""
    few = known.count() <= BROADCAST_ROWS
    known = F.broadcast(known) if few else known
    docs = docs.select(F.col(id_col), F.col(text).alias("_text"))
    whole = docs.select(
        id_col, F.lit("text").alias("unit"), F.lit(None).cast("int").alias("line_no"),
        canonical_digest(F.col("_text")).alias("digest"),
    )
    lines = docs.select(id_col, F.posexplode(F.split("_text", "\n")).alias("line_no", "line")).select(
        id_col, F.lit("line").alias("unit"), "line_no", canonical_digest(F.col("line")).alias("digest")
    )
    return whole.join(known, "digest", "left").unionByName(lines.join(known, "digest")).select(
        id_col, "unit", "line_no", "digest", "license_id"
    )


def op2_license_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of all documents, by entire text and by line."""
    return scan_licences(table(spark, sf_dir, "documents"), known_licences(spark))


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sql_digest(text: str) -> str:
    out = f"regexp_replace(chr(10) || lower({text}), {_sql_text(COPYRIGHT_LINE)}, chr(10), 'g')"
    out = f"regexp_replace(' ' || {out} || ' ', '{SEPARATOR}', '  ', 'g')"
    for written, usual in EQUIVALENT:
        out = f"replace({out}, ' {written} ', ' {usual} ')"
    return f"sha256(trim({out}, ' '))"


OP2_SQL = f"""
WITH known AS (
  SELECT DISTINCT license_id, {_sql_digest("t")} AS digest
  FROM (VALUES {", ".join(f"({_sql_text(k)}, {_sql_text(t)})" for k, t in KNOWN)}) v(license_id, t)
), lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS n
  FROM documents
), units AS (
  SELECT doc_id, 'text' AS unit, CAST(NULL AS INTEGER) AS line_no, {_sql_digest("text")} AS digest FROM documents
  UNION ALL SELECT doc_id, 'line', CAST(n AS INTEGER), {_sql_digest("line")} FROM lines
)
SELECT doc_id, unit, line_no, digest, license_id FROM units LEFT JOIN known USING (digest)
WHERE unit = 'text' OR license_id IS NOT NULL
"""

"""Licences of files: TF-IDF cosine of headers and licence files to templates, then inheritance.

DataFrame functions only. The statements of a file that speak of a licence (all lines of a
licence file) become sparse vectors of terms; a term weighs its count times

    ln((1 + templates) / (1 + templates with the term)) + 1.

A statement has the licence of the template with the largest cosine, from ``threshold`` on; a
file has that of its best statement. A file without one inherits from the licence file in its
directory or else in the nearest directory above: the distinct directories are joined with the
licensed ones by path, and the files with their directories by equality.

Whole headers and licence files are compared beside the single statements, with the standard
source headers and the licence texts of ``license_texts``, as vectors of a space of their own: each
paragraph that speaks of a licence, the comment a file opens with, and all of a licence file. A
licence file that is a known text as a whole has that licence, whatever its sentences name. An
SPDX line gives the identifier or expression it holds, as it is written.

The templates are the only side that is broadcast: a fixed number of texts.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forgelens.sources.staging import stage

# SPDX identifiers and notices that name the licence.
TEMPLATES = [
    ("AGPL-3.0-only", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-2-Clause", "Licensed under the 2-Clause BSD License, the simplified BSD License."),
    ("BSD-3-Clause", "Licensed under the 3-Clause BSD License, the new BSD License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0, the Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0, the Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0, the Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Released under the ISC License."),
    ("LGPL-3.0-only", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This work is subject to the terms of the Mozilla Public License, version 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain, the Unlicense."),
]


def _gnu(spdx: str, name: str, version: str, either: str) -> list[tuple[str, str]]:
    """The notice of a GNU licence, its first paragraph alone and with the two that follow."""
    first = f"This program is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software Foundation, {either}version {version} of the License"
    first += ", or (at your option) any later version." if either else "."
    rest = f"This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details. You should have received a copy of the {name} along with this program. If not, see <https://www.gnu.org/licenses/>."
    return [(spdx, first), (spdx, f"{first} {rest}")]


_APACHE = 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'
HEADERS = [
    ("Apache-2.0", _APACHE),
    ("Apache-2.0", f'{_APACHE} Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("MIT", "Use of this source code is governed by an MIT-style license that can be found in the LICENSE file."),
    ("MIT", "This source code is licensed under the MIT license found in the LICENSE file in the root directory of this source tree."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    *[row for spdx, name, version in [
        ("GPL-2.0", "GNU General Public License", "2"), ("GPL-3.0", "GNU General Public License", "3"), ("AGPL-3.0", "GNU Affero General Public License", "3"),
        ("LGPL-2.1", "GNU Lesser General Public License", "2.1"), ("LGPL-3.0", "GNU Lesser General Public License", "3"),
    ] for either, kind in (("either ", "or-later"), ("", "only")) for row in _gnu(f"{spdx}-{kind}", name, version, either)],
]


def _texts() -> list[tuple[str, str]]:
    """Whole licence texts. That of AGPL-3.0 is made from GPL-3.0, which it differs from by its name and a section."""
    texts = [(p.stem, p.read_text("utf-8", "replace")) for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))]
    gpl = dict(texts)["GPL-3.0-only"]
    return [*texts, ("AGPL-3.0-only", gpl.replace("GNU General Public", "GNU Affero General Public").replace("GNU GENERAL PUBLIC", "GNU AFFERO GENERAL PUBLIC"))]


SPEAKS_OF_LICENCE = "licen[cs]e|copyright|spdx|public domain|creative commons"
LICENCE_FILE = r"^(licen[cs]e|copying|unlicense|notice)([._-].*)?$"
TERM = "[a-z0-9]+(?:[.][0-9]+)*"
THRESHOLD = 0.7
BLOCK_THRESHOLD = 0.8
_ID = "[A-Za-z0-9.+-]*[A-Za-z0-9+]"
SPDX_LINE = rf"(?i:spdx-license-identifier):[ \t]*([(]*{_ID}(?:[ \t)]+(?:OR|AND|WITH)[ \t(]+{_ID})*[)]*)"
COMMENT_LINE = r"^[ \t]*(#|//|/?[*]|--|;|%|dnl\b|(?i:rem)\b|[.][.]|$)"
COMMENT = r"^\s*(?:/[*]|<!--|[{]-|[(][*]|\"\"\"|''')([\s\S]*?)(?:[*]/|-->|-[}]|[*][)]|\"\"\"|''')"


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({TERM})"), F.lit(1))


def _weights(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    """(template, spdx, term, weight, idf), weights of unit length for each template."""
    rows = [(k, spdx, text) for k, (spdx, text) in enumerate(templates)]
    terms = spark.createDataFrame(rows, "template int, spdx string, text string").select("template", "spdx", F.explode(_terms(F.col("text"))).alias("term"))
    counts = terms.groupBy("template", "spdx", "term").agg(F.count("*").alias("n"))
    have = counts.groupBy("term").agg(F.count("*").alias("have"))
    weighed = counts.join(F.broadcast(have), "term").withColumn("idf", F.ln(F.lit(1.0 + len(rows)) / (F.col("have") + 1.0)) + 1.0)
    length = F.sqrt(F.sum(F.pow(F.col("n") * F.col("idf"), 2)).over(Window.partitionBy("template")))
    return weighed.select("template", "spdx", "term", (F.col("n") * F.col("idf") / length).alias("weight"), "idf")


def statements(files: DataFrame) -> DataFrame:
    """(file, statement, text) of what a file says about its licence; ``files``: file, name, text."""
    speaks = F.col("text").rlike(f"(?i){SPEAKS_OF_LICENCE}")
    is_licence = F.coalesce(F.lower("name").rlike(LICENCE_FILE), F.lit(False))
    lines = F.split(F.regexp_replace("text", r"([.!?])[ \t\r\n]+", "$1\n"), "\n")
    said = F.filter(lines, lambda x: F.lower(x).rlike(SPEAKS_OF_LICENCE) | is_licence)
    return files.where(speaks).select("file", F.posexplode(said).alias("statement", "text"))


def blocks(files: DataFrame) -> DataFrame:
    """(file, whole, text) of the paragraphs and the opening comment of a file that speak of a licence,
    and of all of a licence file, which is ``whole``."""
    speaks = lambda x: F.lower(x).rlike(SPEAKS_OF_LICENCE)
    is_licence = F.coalesce(F.lower("name").rlike(LICENCE_FILE), F.lit(False))
    plain = F.regexp_replace("text", "\r", "")
    lines = F.split(plain, "\n")
    code = F.array_position(F.transform(lines, lambda x: x.rlike(COMMENT_LINE)), False)
    opening = F.array_join(F.slice(lines, 1, F.when(code > 0, code - 1).otherwise(F.size(lines)).cast("int")), "\n")
    # A line without letters and digits, as of comment marks alone, parts paragraphs.
    paragraphs = F.split(F.regexp_replace(plain, r"(?m)^[^\p{L}\p{N}\n]+$", ""), "\n\n+")
    parts = F.array_distinct(F.filter(F.concat(paragraphs, F.array(opening, F.regexp_extract(plain, COMMENT, 1))), speaks))
    every = F.transform(parts, lambda x: F.struct(F.lit(False).alias("whole"), x.alias("text")))
    whole = F.when(is_licence, F.array(F.struct(F.lit(True).alias("whole"), F.col("text").alias("text")))).otherwise(F.expr("array()"))
    said = files.where(F.col("text").rlike(f"(?i){SPEAKS_OF_LICENCE}"))
    return said.select("file", F.explode(F.concat(every, whole)).alias("b")).select("file", "b.whole", "b.text")


def spdx_lines(files: DataFrame) -> DataFrame:
    """(file, license) of what the SPDX lines of a file name."""
    named = F.regexp_extract_all("text", F.lit(SPDX_LINE), F.lit(1))
    return files.select("file", F.explode(named).alias("license"))


def match_templates(said: DataFrame, threshold: float = THRESHOLD, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """(file, license, cosine): the best template of each file that has one."""
    weights = stage(_weights(said.sparkSession, templates))
    # Equal statements, of any number of files, are compared once. A row of a term has the text's
    # digest and not the text, whose length times its terms would be stored.
    said = said.select("file", F.sha2("text", 256).alias("said"), "text")
    distinct = said.groupBy("said").agg(F.first("text").alias("text"))
    terms = distinct.select("said", F.explode(_terms(F.col("text"))).alias("term")).groupBy("said", "term").agg(F.count("*").alias("n"))
    idf = weights.groupBy("term").agg(F.first("idf").alias("idf"))
    weighed = terms.join(F.broadcast(idf), "term", "left").withColumn("w", F.col("n") * F.coalesce("idf", F.ln(F.lit(1.0 + len(templates))) + 1.0))
    weighed = stage(weighed.select("said", "term", "w"))
    lengths = weighed.groupBy("said").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    products = weighed.join(F.broadcast(weights), "term").groupBy("said", "template", "spdx").agg(F.sum(F.col("w") * F.col("weight")).alias("product"))
    cosine = F.round(F.col("product") / F.col("length"), 6)
    scored = products.join(lengths, "said").select("said", F.struct((-cosine).alias("minus"), "spdx", "template").alias("match"))
    # Stored: a join between two shuffles is split where a statement is frequent, one with a sum is not.
    best = stage(scored.groupBy("said").agg(F.min("match").alias("match")).where(-F.col("match.minus") >= threshold))
    found = said.select("file", "said").join(best, "said").groupBy("file").agg(F.min("match").alias("match"))
    return found.select("file", F.col("match.spdx").alias("license"), (-F.col("match.minus")).alias("cosine"))


def _own(files: DataFrame, threshold: float) -> DataFrame:
    """(file, license, cosine) of what each of ``files`` (file, name, text) says itself."""
    long = HEADERS + _texts()
    parts = stage(blocks(files))
    rank = lambda found, n: found.select("file", F.lit(n).alias("rank"), "license", "cosine")
    found = rank(match_templates(statements(files), threshold), 1)
    found = found.unionByName(rank(match_templates(parts.where("whole"), BLOCK_THRESHOLD, long), 0))
    found = found.unionByName(rank(match_templates(parts.where("not whole"), BLOCK_THRESHOLD, long), 1))
    found = found.unionByName(rank(spdx_lines(files).withColumn("cosine", F.lit(1.0)), 0))
    best = found.groupBy("file").agg(F.min(F.struct("rank", (-F.col("cosine")).alias("minus"), "license")).alias("m"))
    return best.select("file", F.col("m.license").alias("license"), (-F.col("m.minus")).alias("cosine"))


def scan(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(file, path, license, cosine, found_in) of every row of ``files`` (file, path, text).

    ``file`` is a key. found_in is 'file' for a licence of the file's own, the directory it is
    inherited from, or null. A null or empty text says nothing; a null path has no directory.
    Of several licence files in a directory the largest cosine counts, then the smaller
    identifier. Rows repeated under one key share its best statement. An empty table gives an empty result.
    """
    spark = files.sparkSession
    directory = F.regexp_replace("path", "/?[^/]*$", "")
    name = F.regexp_extract("path", "([^/]*)$", 1)
    own = stage(_own(files.select("file", name.alias("name"), "text"), threshold))
    placed = stage(files.select("file", "path", directory.alias("dir"), name.alias("name")).join(own, "file", "left"))
    licensed = placed.where(F.col("license").isNotNull() & F.lower("name").rlike(LICENCE_FILE))
    licensed = licensed.groupBy(F.col("dir").alias("above")).agg(F.min(F.struct((-F.col("cosine")).alias("minus"), "license")).alias("m"))
    dirs = placed.where("dir is not null").select("dir").distinct()
    parts = F.split("dir", "/")
    ancestors = dirs.select("dir", F.explode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, 1, n), "/").alias("above")))).alias("a"))
    nearest = (
        ancestors.select("dir", "a.depth", "a.above").join(licensed, "above").groupBy("dir")
        .agg(F.max(F.struct("depth", "above", "m")).alias("n")).select(F.col("dir").alias("__dir"), F.col("n.above").alias("above"), F.col("n.m.license").alias("given"))
    )
    out = placed.join(stage(nearest), F.col("dir") == F.col("__dir"), "left")
    found_in = F.when(F.col("license").isNotNull(), F.lit("file")).otherwise(F.col("above"))
    return out.select("file", "path", F.coalesce("license", "given").alias("license"), "cosine", found_in.alias("found_in"))


def op5_license_scan(docs: DataFrame) -> DataFrame:
    """doc_id, path, license, cosine, found_in of all documents.

    The documents are laid out as files ``source/lang/name-id``; a document of up to 40 words
    that speaks of a licence is taken for the licence file of its directory.
    """
    is_licence = (F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")) <= 40) & F.col("text").rlike(f"(?i){SPEAKS_OF_LICENCE}")
    kind = F.when(is_licence, F.lit("LICENSE-")).otherwise(F.lit("text-"))
    path = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")), F.concat(kind, F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    files = docs.select(F.col("doc_id").alias("file"), path.alias("path"), "text")
    return scan(files).select(F.col("file").alias("doc_id"), "path", "license", "cosine", "found_in")


def _oracle() -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({k}, {quoted(spdx)}, {quoted(text)})" for k, (spdx, text) in enumerate(TEMPLATES))
    n = float(len(TEMPLATES))
    speaks, words = f"'(?i){SPEAKS_OF_LICENCE}'", r"'[^\x20\x09-\x0D]+'"
    return f"""
with t(template, spdx, text) as (values {values}),
tc as (select template, spdx, term, count(*) as n from (select template, spdx, unnest(regexp_extract_all(lower(text), '{TERM}')) as term from t) group by all),
ti as (select term, ln({1 + n}::double / (count(*) + 1)) + 1 as idf from tc group by term),
tl as (select template, sqrt(sum((n * idf) ** 2)) as length from tc join ti using (term) group by template),
tw as (select template, spdx, term, n * idf / length as weight from tc join ti using (term) join tl using (template)),
f as (
  select doc_id, text, coalesce(source, 'none') || '/' || coalesce(lang, 'none') as dir,
    coalesce(len(regexp_extract_all(text, {words})) <= 40 and regexp_matches(text, {speaks}), false) as is_licence from documents),
s as (
  select doc_id, line from (
    select doc_id, is_licence, unnest(string_split(regexp_replace(text, '([.!?])[ \\t\\r\\n]+', '\\1' || chr(10), 'g'), chr(10))) as line
    from f where regexp_matches(text, {speaks}))
  where is_licence or regexp_matches(lower(line), '{SPEAKS_OF_LICENCE}')),
d as (select distinct line from s),
st as (
  select line, term, count(*) * coalesce(any_value(idf), ln({1 + n}::double) + 1) as w
  from (select line, unnest(regexp_extract_all(lower(line), '{TERM}')) as term from d) left join ti using (term) group by line, term),
sl as (select line, sqrt(sum(w * w)) as length from st group by line),
sp as (select line, template, spdx, sum(w * weight) as product from st join tw using (term) group by all),
sc as (select line, template, spdx, round(product / length, 6) as cosine from sp join sl using (line)),
sb as (select * from (select *, row_number() over (partition by line order by cosine desc, spdx, template) as r from sc) where r = 1 and cosine >= {THRESHOLD}),
o as (select * from (select doc_id, spdx, cosine, row_number() over (partition by doc_id order by cosine desc, spdx, template) as r from s join sb using (line)) where r = 1),
l as (
  select * from (select dir, spdx, row_number() over (partition by dir order by cosine desc, spdx) as r from f join o using (doc_id) where is_licence) where r = 1)
select f.doc_id, f.dir || '/' || case when is_licence then 'LICENSE-' else 'text-' end || coalesce(f.doc_id::varchar, 'none') as path,
  coalesce(o.spdx, l.spdx) as license, o.cosine, case when o.spdx is not null then 'file' when l.spdx is not null then l.dir end as found_in
from f left join o on o.doc_id = f.doc_id left join l on l.dir = f.dir
"""


OP5_SQL = _oracle()

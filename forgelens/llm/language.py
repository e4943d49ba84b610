"""Language of a text by compression with a dictionary of each language.

Each language has a raw-content dictionary of at most ``DICTIONARY`` bytes of its lower-cased
training texts. A text, lower-cased, is compressed whole with every dictionary; the language
of the smallest result is chosen. The score is the share by which the next larger result is
larger; below ``min_margin`` the choice is marked as rejected. Equal sizes go to the language
with more training texts.

The dictionaries come from about ``SAMPLE`` documents a language, picked by a hash of their id: the
only sample here. A sampled text is parted into equal stretches, up to ``PARTS``, each of which gives at most
``PIECE`` characters from a hashed place in it; texts that are no longer than all of these go in whole. The documents take turns, one
piece each, until the dictionary is full. The dictionaries are broadcast, and their size is bounded
by that of one times the number of languages.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgelens.llm.common import append_columns, held_out

DICTIONARY = 1 << 17
SAMPLE = 512
PARTS = 8
PIECE = 256
MIN_MARGIN = 0.005
UNKNOWN = "und"


def has_letter(text: str | None) -> bool:
    """Whether a character of the text is a letter by its Unicode category; numerals are none."""
    return text is not None and any(map(str.isalpha, text))


@dataclass
class Dictionaries:
    """Dictionary of each language, the most frequent language first."""

    content: dict[str, bytes]

    def compressors(self) -> dict[str, zstandard.ZstdCompressor]:
        how = zstandard.ZstdCompressionParameters(
            strategy=zstandard.STRATEGY_GREEDY, min_match=4, search_log=3, chain_log=16, hash_log=17, window_log=20,
            write_checksum=False, write_content_size=False, write_dict_id=False,
        )
        out = {}
        for lang, content in self.content.items():
            known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(compression_params=how)
            out[lang] = zstandard.ZstdCompressor(dict_data=known, compression_params=how)
        return out


def _pieces() -> Column:
    """Lower-case pieces of ``text``, one of each of its equal stretches."""
    size = F.length("text").cast("long")
    parts = F.greatest(F.lit(1), F.least(F.lit(PARTS), F.ceil(size / PIECE)))

    def piece(part: Column) -> Column:
        start = F.floor(part * size / parts)
        wide = F.floor((part + 1) * size / parts) - start
        shift = F.pmod(F.xxhash64("doc_id", "text", part), F.greatest(wide - PIECE, F.lit(0)) + 1)
        return F.lower(F.substring(F.col("text"), (start + shift + 1).cast("int"), F.least(wide, F.lit(PIECE)).cast("int")))

    return F.transform(F.sequence(F.lit(0), parts - 1), piece)


def _content(texts: list[list[str]]) -> bytes:
    """At most ``DICTIONARY`` bytes of pieces, one of each text in turn; texts begin at different stretches."""
    out, size = [], 0
    for turn in range(PARTS):
        for k, pieces in enumerate(texts):
            if turn < len(pieces) and size < DICTIONARY:
                out.append(pieces[(turn + k) % len(pieces)].encode("utf-8", "surrogatepass"))
                size += len(out[-1]) + 1
    return b"\n".join(out)[:DICTIONARY]


def learn(docs: DataFrame) -> Dictionaries:
    """Dictionaries from ``docs`` (doc_id, text, lang). Rows with a null text or lang teach nothing."""
    known = docs.where("text is not null and lang is not null")
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return Dictionaries({})
    share = docs.sparkSession.createDataFrame([(k, SAMPLE / n) for k, n in counts.items()], "__lang string, __share double")
    drawn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    sample = known.join(share, F.col("lang") == F.col("__lang")).where(drawn < F.col("__share"))
    rows = sample.select("lang", drawn.alias("at"), _pieces().alias("pieces")).collect()
    texts: dict[str, list[list[str]]] = {lang: [] for lang in counts}
    for row in sorted(rows, key=lambda r: (r["lang"], r["at"], r["pieces"])):
        texts[row["lang"]].append(row["pieces"])
    ordered = sorted(counts, key=lambda lang: (-counts[lang], lang))
    # The start of a dictionary is the first to go out of reach; zstandard wants 8 bytes at least.
    return Dictionaries({lang: (_content(texts[lang]) or lang.encode()).ljust(8) for lang in ordered})


def classify(docs: DataFrame, dictionaries: Dictionaries, min_margin: float = MIN_MARGIN) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1) and ``rejected``.

    A null text and one without a letter have ``und``, 0 and true; so has every text where no
    language is known. With one language its score is 1. Columns with these names are replaced.
    """
    content = docs.sparkSession.sparkContext.broadcast(dictionaries.content)

    def rows(batches):
        compressors = Dictionaries(content.value).compressors()
        for batch in batches:
            found = []
            for text in batch.column(0).to_pylist():
                if not compressors or not has_letter(text):
                    found.append((UNKNOWN, 0.0, True))
                    continue
                raw = text.lower().encode("utf-8", "surrogatepass")
                sizes = sorted((len(c.compress(raw)), k, lang) for k, (lang, c) in enumerate(compressors.items()))
                score = (sizes[1][0] - sizes[0][0]) / sizes[1][0] if len(sizes) > 1 else 1.0
                found.append((sizes[0][2], score, score < min_margin))
            yield [pa.array([f[k] for f in found], t) for k, t in enumerate((pa.string(), pa.float64(), pa.bool_()))]

    adds = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    return append_columns(docs, ["text"], adds, rows)


def op2_language_id(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of all documents; learns from the rows not held out."""
    known = learn(docs.where(~held_out("doc_id", 4, 2)))
    out = classify(docs.select("doc_id", "text"), known)
    return out.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score", "rejected")

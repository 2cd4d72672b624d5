"""Language identification by compression: the language whose dictionary encodes a text shortest."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import first_by_hash

UNDETERMINED = "und"
#: A text is encoded in blocks, all of them, so that the dictionary counts as much at its end as at its start.
BLOCK = 2048
#: Log-odds of a language for each share of the size that its dictionary saves over the next best one.
SLOPE = 60.0
OTHER = re.compile(r"[\W\d_]+")


def plain(text: str) -> str:
    """Lower case, with every run of other characters than letters as one space."""
    return OTHER.sub(" ", text.lower())


def learned(docs: DataFrame, samples: int = 400, dictionary_bytes: int = 65536, seed: int = 11) -> dict[str, bytes]:
    """A raw-content dictionary for each language of ``docs (doc_id, text, lang)``.

    Fitted on a bounded sample: of each language the ``samples`` documents that come first by a hash of
    their id, of each a passage from its middle, cut to ``dictionary_bytes`` together. Ids are chosen
    without reading texts. Languages come with the most frequent first. Null languages, ids and texts are
    not learned from.
    """
    named = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    chosen = first_by_hash(named.select("lang", "doc_id"), "lang", F.lit(samples), seed)
    share = dictionary_bytes // samples * 4
    pieces = (
        named.join(F.broadcast(chosen.select("lang", "doc_id")), ["lang", "doc_id"], "left_semi")
        .where(F.length("text") > 0)
        # The middle of a long text, so that headers do not fill the dictionary.
        .select("lang", "doc_id", F.substring("text", F.greatest(F.lit(1), (F.length("text") / 2 - share / 2).cast("int")), F.lit(share)).alias("piece"))
    )
    ranked = named.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()
    found: dict[str, list] = {row["lang"]: [] for row in ranked}
    # No more rows than the samples, however often an id repeats.
    pieces = pieces.groupBy("lang", "doc_id").agg(F.min("piece").alias("piece"))
    for row in pieces.orderBy("lang", F.xxhash64("doc_id", F.lit(seed)), "doc_id", "piece").collect():
        found[row["lang"]].append(plain(row["piece"]).encode())
    return {lang: b"\n".join(parts)[:dictionary_bytes] for lang, parts in found.items() if parts}


class Identifier:
    """Sizes of a text under each language's dictionary."""

    def __init__(self, dictionaries: dict[str, bytes], level: int):
        self.langs = list(dictionaries)
        self.encoders = []
        for lang in self.langs:
            content = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=level)
            self.encoders.append(zstandard.ZstdCompressor(
                dict_data=content, write_content_size=False, write_checksum=False, write_dict_id=False
            ))

    def sizes(self, text: str) -> list[int]:
        data = text.encode("utf-8", "surrogatepass")
        parts = [data[at:at + BLOCK] for at in range(0, len(data), BLOCK)]
        return [sum(len(e.compress(p)) for p in parts) for e in self.encoders]

    def label(self, text: str | None) -> tuple[str, float, float]:
        """Language, score and margin; the margin is the share of the best size that the second adds."""
        if not text or not self.langs or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0, 0.0
        sizes = self.sizes(plain(text))
        order = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))
        best = sizes[order[0]]
        odds = [2.718281828459045 ** (-SLOPE * (s - best) / best) for s in sizes]
        margin = (sizes[order[1]] - best) / best if len(sizes) > 1 else 1.0
        return self.langs[order[0]], 1.0 / sum(odds), margin


def identify(docs: DataFrame, dictionaries: dict[str, bytes], margin: float = 0.01, level: int = 5) -> DataFrame:
    """``doc_id, lang string, best string, score double, margin double, rejected boolean`` for each document.

    ``best`` is the language whose dictionary gives the smallest encoding of the whole text, ``und`` where
    the text is null or has no letter, or nothing was learned. ``lang`` is ``best``, or null where
    ``margin`` is not reached (``rejected``). Equal sizes go to the more frequent language. Repeated rows
    are answered each; a null id stays null; an empty table gives no rows; other columns are ignored.
    """

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Identifier(dictionaries, level)
        for batch in batches:
            best, score, gap = [], [], []
            for text in batch["text"]:
                one = known.label(text.as_py())
                best.append(one[0])
                score.append(one[1])
                gap.append(one[2])
            out = [b != UNDETERMINED and g < margin for b, g in zip(best, gap, strict=True)]
            yield pa.record_batch({
                "doc_id": batch["doc_id"],
                "lang": pa.array([None if r else b for b, r in zip(best, out, strict=True)], pa.string()),
                "best": pa.array(best, pa.string()), "score": pa.array(score, pa.float64()),
                "margin": pa.array(gap, pa.float64()), "rejected": pa.array(out, pa.bool_()),
            })

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        label, "doc_id long, lang string, best string, score double, margin double, rejected boolean"
    )

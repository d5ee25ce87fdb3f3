"""Language identification by compression.

Each language has a raw-content zstandard dictionary cut from a bounded sample
of labelled texts. A text is encoded with every dictionary, in independent
blocks so that the dictionary matters along the whole text, and the language
of the smallest encoding wins. Narrow margins are rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from cartoledger.llm.common import pieces

UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")


def dictionaries(
    labelled: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    id_col: str = "doc_id",
    rows: int = 2000,
    budget: int = 96_000,
) -> dict[str, bytes]:
    """Raw dictionary per language from a bounded sample of whole texts, short ones included.

    Per language, texts are taken in the order of the hash of their id until
    ``budget`` bytes are full (the last one is taken whole) or ``rows`` are
    taken; those longer than a sixteenth of the budget come after all others,
    so that a few long texts do not make up a dictionary. The sample is the same
    however the table is partitioned. A count per language comes first, and only
    texts whose hash is low enough for about twice ``rows`` of them leave their
    tasks, so no task gets more however large a language is. Rows without a
    language or a letter are passed over.
    """
    whole = Window.partitionBy("lang").orderBy("long", "rank", "text")
    own = (
        labelled.select(
            labelled[lang_col].alias("lang"),
            F.xxhash64(labelled[id_col].cast("string")).alias("rank"),
            labelled[text_col].alias("text"),
            (F.octet_length(labelled[text_col]) > budget // 16).alias("long"),
        )
        .where("lang is not null and text is not null")
        .where(F.col("text").rlike(r"\p{L}"))
    )
    # A row per language, as many as there are dictionaries.
    counts = [(r["lang"], min(1.0, (2 * rows + 64) / r["n"])) for r in own.groupBy("lang").agg(F.count("*").alias("n")).collect()]
    if not counts:
        return {}
    shares = F.broadcast(labelled.sparkSession.createDataFrame(counts, "lang string, share double"))
    sample = (
        own.join(shares, "lang")
        .where(F.col("rank") / F.lit(2.0**64) + F.lit(0.5) <= F.col("share"))
        .withColumn("n", F.row_number().over(whole))
        .withColumn("bytes", F.sum(F.octet_length("text").cast("long")).over(whole) - F.octet_length("text"))
        .where((F.col("n") <= rows) & (F.col("bytes") < budget))
        .orderBy("lang", "n")
    )
    texts: dict[str, list[bytes]] = {}
    for row in sample.select("lang", "text").collect():
        texts.setdefault(row["lang"], []).append(folded(row["text"].encode()))
    return {lang: b"\n".join(found) for lang, found in sorted(texts.items())}


def folded(data: bytes) -> bytes:
    """Lower case: words written in capitals code like any others."""
    return data.decode("utf-8", "replace").lower().encode()


class Coder:
    """Encoders of all languages."""

    def __init__(self, raw: dict[str, bytes], level: int = 6, block: int = 2048) -> None:
        self.langs = list(raw)
        self.block = block
        self.encoders = []
        for data in raw.values():
            words = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            words.precompute_compress(level=level)
            self.encoders.append(
                zstandard.ZstdCompressor(
                    level=level, dict_data=words, write_content_size=False, write_checksum=False, write_dict_id=False
                )
            )

    def sizes(self, data: bytes) -> list[int]:
        """Bytes of ``data`` encoded with each dictionary."""
        blocks = [data[i : i + self.block] for i in range(0, len(data), self.block)]
        return [sum(len(e.compress(b)) for b in blocks) for e in self.encoders]

    def predict(self, data: bytes, margin_bytes: int, margin_share: float) -> tuple[str, float, bool]:
        """``(language, score, accepted)``.

        The score is the winner's share when sizes are read as code lengths.
        Ties go to the language first in order of name. Accepted if the
        runner-up needs ``margin_bytes`` more and ``margin_share`` more.
        """
        if not self.langs or not _LETTER.search(data.decode("utf-8", "replace")):
            return UNKNOWN, 0.0, False
        sizes = self.sizes(folded(data))
        order = sorted(range(len(sizes)), key=lambda i: (sizes[i], self.langs[i]))
        best = sizes[order[0]]
        score = 1.0 / sum(2.0 ** max(-1000, -8 * (s - best)) for s in sizes)
        gap = sizes[order[1]] - best if len(order) > 1 else best
        return self.langs[order[0]], score, gap >= margin_bytes and gap >= margin_share * best


def identify(
    docs: DataFrame,
    raw: dict[str, bytes],
    id_col: str = "doc_id",
    text_col: str = "text",
    margin_bytes: int = 2,
    margin_share: float = 0.005,
    level: int = 6,
    block: int = 2048,
) -> DataFrame:
    """``(doc_id, lang_pred, score, accepted)``, one row per row of ``docs``; whole texts, no shuffle.

    A null text or one without a letter is ``und`` with score 0; without any
    dictionary every text is. ``accepted`` is false where the margin is narrow.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("accepted", pa.bool_())]
    )
    shared = docs.sparkSession.sparkContext.broadcast(raw)  # bounded by the budget per language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(shared.value, level, block)
        for batch in pieces(batches, "text"):
            found = [coder.predict(t, margin_bytes, margin_share) for t in batch.column("text").to_pylist()]
            columns = [pa.array(c, schema.field(i + 1).type) for i, c in enumerate(zip(*found, strict=True))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], schema=schema)

    return docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        F.coalesce(docs[text_col].cast("binary"), F.lit(b"")).alias("text"),
    ).mapInArrow(run, "doc_id long, lang_pred string, score double, accepted boolean")

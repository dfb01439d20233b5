"""Language identification by compression.

Each language has a zstandard raw-content dictionary: passages of its own
texts. A text is compressed once with every dictionary, block by block, and
the language with the smallest sum of sizes is chosen; a narrow margin to the
second rejects the choice. Texts and passages are compared as lower-case
letters with single spaces between, so digits and marks tell nothing.

Training takes a bounded sample: ``DICTIONARY`` bytes of passages a language
(all languages together ``ALL_DICTIONARIES`` at most) and ``TRIALS`` more to
put differences of sizes on a scale from 0 to 1. A passage is ``PASSAGE``
characters of any place of any text; those with the smallest hashes are taken,
so the sample is the same for every layout of the tables and each place counts
alike. Passages and texts of each language are counted over all rows first;
the counts give the hash bound that keeps the sample small before it is
shuffled. At most ``LANGUAGES`` languages can be learned, more raise an error.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

UNDETERMINED = "und"
DICTIONARY, ALL_DICTIONARIES, LANGUAGES = 1 << 17, 64 << 20, 4096
PASSAGE, TRIALS = 400, 100
BLOCK = 4096                # characters of a text compressed at a time
LEVEL = 6
SHORT, TIMES = 64, 4        # zstandard saves nothing on very few bytes: shorter blocks are compressed this often in a row
MARGIN = 0.02               # (second - best) / second below which a choice is rejected
_NEW = ["lang_pred", "score", "margin", "language"]


def _letters(text: str) -> bytes:
    """``text`` as lower-case letters between spaces, other characters as one space; empty without letters."""
    import regex
    words = regex.sub(r"\P{L}+", " ", text.lower()).strip()
    return f" {words} ".encode() if words else b""


@dataclass
class Model:
    """Languages, those of more training texts first, their dictionaries and the scale of the score."""

    languages: list[str]
    dictionaries: list[bytes]
    scale: float = 1.0
    _compressors: list = field(default_factory=list, repr=False)

    def __getstate__(self):
        return {"languages": self.languages, "dictionaries": self.dictionaries, "scale": self.scale,
                "_compressors": []}

    def _ready(self) -> list:
        if not self._compressors:
            import zstandard
            params = zstandard.ZstdCompressionParameters.from_level(
                LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
            for content in self.dictionaries:
                kept = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                kept.precompute_compress(compression_params=params)
                self._compressors.append(zstandard.ZstdCompressor(dict_data=kept, compression_params=params))
        return self._compressors

    def sizes(self, text: str) -> np.ndarray | None:
        """Compressed bytes of the whole text under each language; None if it has no letter."""
        total, found = np.zeros(len(self.languages), np.int64), False
        for at in range(0, len(text), BLOCK):
            block = _letters(text[at:at + BLOCK])
            if block:
                found = True
                if len(block) < SHORT:
                    block *= TIMES
                total += [len(c.compress(block)) for c in self._ready()]
        return total if found else None

    def predict(self, text: str | None) -> tuple[str, float, float, str | None]:
        """(nearest language, score, margin, the language or None if rejected) of a text."""
        sizes = self.sizes(text) if text and self.languages else None
        if sizes is None:
            return UNDETERMINED, 0.0, 0.0, None
        best = int(np.argmin(sizes))          # of equal ones the first, the language with more texts
        if len(sizes) == 1:
            return self.languages[0], 1.0, 1.0, self.languages[0]
        second = int(np.partition(sizes, 1)[1])
        margin = (second - int(sizes[best])) / second
        score = 1 / np.exp(-self.scale * np.minimum(sizes - sizes[best], 700 / self.scale)).sum()
        return self.languages[best], float(score), margin, self.languages[best] if margin >= MARGIN else None


def _passages(bounds: dict[str, int]):
    """Emit the passages of each language whose hash is under its bound, each once a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        for batch in batches:
            found = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                bound = bounds.get(lang, 0)
                for at in range(0, len(text), PASSAGE):
                    part = text[at:at + PASSAGE]
                    h = xxhash.xxh64_intdigest(part.encode("utf-8", "replace"))
                    if h < bound:
                        found[lang, h >> 1] = part
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.int64()),
                 pa.array(list(found.values()), pa.string())], names=["lang", "h", "passage"])
    return run


def _fitted_scale(model: Model, trials: list[tuple[int, str]]) -> float:
    """The scale under which the trials' own languages are likeliest (a grid, finest at a tenth)."""
    seen = [(k, s) for k, s in ((k, model.sizes(p)) for k, p in trials) if s is not None]
    if not seen or len(model.languages) < 2:
        return 1.0
    own, size = np.array([k for k, _ in seen]), np.array([s for _, s in seen], float)
    weight = 1 / np.bincount(own, minlength=len(model.languages))[own]      # languages weigh the same
    grid = np.exp(np.linspace(math.log(0.01), math.log(2), 54))

    def miss(scale: float) -> float:
        z = -scale * (size - size.min(1, keepdims=True))
        return float((weight * (np.log(np.exp(z).sum(1)) - z[np.arange(len(own)), own])).sum())
    return float(min(grid, key=miss))


def train(docs: DataFrame) -> Model:
    """Learn from ``docs`` (text, lang and any others); rows with a null text or lang are left out.

    Without such rows the model has no language and all texts are undetermined.
    """
    learn = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).filter(
        "lang is not null and length(text) > 0")
    counts = (learn.groupBy("lang").agg(F.count("*").alias("texts"),
                                        F.sum(F.ceil(F.char_length("text") / PASSAGE)).alias("passages"))
              .limit(LANGUAGES + 1).collect())
    if len(counts) > LANGUAGES:
        raise ValueError(f"over {LANGUAGES} languages to learn")
    if not counts:
        return Model([], [])
    room = min(DICTIONARY, ALL_DICTIONARIES // len(counts))
    take = room // PASSAGE + 1
    wanted = take + TRIALS
    # four times as many as wanted are expected under the bound, so repeated passages do no harm
    bounds = {r.lang: min(1 << 64, (4 * wanted << 64) // r.passages) for r in counts}
    some = (learn.mapInArrow(_passages(bounds), "lang string, h long, passage string")
            .groupBy("lang", "h").agg(F.min("passage").alias("passage")))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    rows = some.withColumn("place", place).filter(F.col("place") <= wanted).orderBy("lang", "place").collect()
    order = sorted(counts, key=lambda r: (-r.texts, r.lang))
    parts: dict[str, list[str]] = {r.lang: [] for r in order}
    for r in rows:
        parts[r.lang].append(r.passage)
    # where few passages were found, a quarter of them stays for the trials
    cut = {lang: min(take, max(1, len(p) * 3 // 4)) for lang, p in parts.items()}
    contents = [b"".join(_letters(x) for x in parts[r.lang][:cut[r.lang]])[:room] for r in order]
    known = [k for k, content in enumerate(contents) if content]
    model = Model([order[k].lang for k in known], [contents[k] for k in known])
    model.scale = _fitted_scale(model, [(i, x) for i, lang in enumerate(model.languages)
                                        for x in parts[lang][cut[lang]:]])
    return model


def identify(docs: DataFrame, model: Model, keep_text: bool = True) -> DataFrame:
    """``docs`` (text and any others) with lang_pred, score, margin and language.

    ``lang_pred`` is the learned language under which the whole text is
    smallest, ``und`` with score 0 if the text is null or has no letter or
    nothing was learned. ``score`` is from 0 to 1, higher when surer.
    ``language`` is null where the margin is narrow or the text undetermined.
    Of equal sizes the language with more training texts is taken, then the
    smaller name. Columns that are named like the new ones are replaced.
    """
    docs = docs.drop(*_NEW)
    at = docs.columns.index("text")
    schema = docs.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0), "margin": F.lit(0.0),
                               "language": F.lit(None).cast("string")}).schema
    if not keep_text:
        schema = docs.drop("text").withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0), "margin": F.lit(0.0),
                                                "language": F.lit(None).cast("string")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(t.as_py()) for t in batch.column(at)]
            kept = [c for k, c in enumerate(batch.columns) if keep_text or k != at]
            names = [n for k, n in enumerate(batch.schema.names) if keep_text or k != at]
            kinds = (pa.string(), pa.float64(), pa.float64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [*kept, *(pa.array([f[k] for f in found], kind) for k, kind in enumerate(kinds))], names=[*names, *_NEW])
    return docs.mapInArrow(run, schema)

"""Language identification by hyperdimensional n-gram profiles.

Every letter has a random vector of +1 and -1. An n-gram's vector binds the
letters' vectors, each rotated by its place in the n-gram, by elementwise
product. A text's vector bundles (adds) those of its n-grams. A language's
prototype bundles the length-normalised vectors of its training texts; a
text gets the language whose prototype has the largest cosine.

Texts are lower-cased; runs of anything that is not a letter count as one
space, also before and after the text. Training vectors are added as
integers, so the prototypes don't depend on the order of rows.

Cases: a null text, or one without any letter, is ``und`` with score 0;
rows without a language teach nothing; without any training row all texts
are ``und``; ties go to the language that sorts first; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricekit.llm import _hash

DIMENSIONS, GRAM, SCALE = 1024, 3, 1 << 20
UNKNOWN = "und"
#: Least scores of known languages by number of letters, for 1024 dimensions (README: how they were fitted).
BOUNDS = ((0, 1 / 32), (32, 0.16), (4096, 0.2))


def letter_vectors(codes: np.ndarray, dimensions: int) -> np.ndarray:
    """The random vectors of +1 and -1 of some code points."""
    blocks = dimensions // 64
    bits = _hash.mix(codes.astype(np.uint64)[:, None] * np.uint64(_hash.BASE) + _hash.seeds(blocks, 5)[None, :])
    return (np.unpackbits(bits.view(np.uint8), axis=1).astype(np.int8) * 2 - 1)


class Profiles:
    """Vectors of texts; keeps the vectors of the n-grams met so far (at most ``most``)."""

    def __init__(self, dimensions: int = DIMENSIONS, gram: int = GRAM, most: int = 60_000):
        self.dimensions, self.gram, self.most = dimensions, gram, most
        self.other = re.compile(r"[\W\d_]+")
        self.clear()

    def clear(self):
        self.codes = np.zeros(0, np.uint64)
        self.place = np.zeros(0, np.int64)
        self.vectors = np.zeros((0, self.dimensions), np.int8)

    def grams(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Codes and counts of a text's n-grams; none if it has no letter."""
        clean = self.other.sub(" ", text.lower()).strip()
        if not clean:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        letters = np.frombuffer(f" {clean} ".encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
        n = len(letters) - self.gram + 1
        codes = np.zeros(n, np.uint64)
        for k in range(self.gram):
            codes = codes << np.uint64(21) | letters[k:k + n]
        return np.unique(codes, return_counts=True)

    def rows(self, codes: np.ndarray) -> np.ndarray:
        """Where the vectors of these sorted n-grams stand; missing ones are made."""
        at = np.searchsorted(self.codes, codes)
        known = at < len(self.codes)
        known[known] = self.codes[at[known]] == codes[known]
        if not known.all():
            if len(self.codes) > self.most:
                self.clear()
                return self.rows(codes)
            new = codes[~known]
            made = np.ones((len(new), self.dimensions), np.int8)
            for k in range(self.gram):
                letter = (new >> np.uint64(21 * (self.gram - 1 - k))) & np.uint64((1 << 21) - 1)
                made *= np.roll(letter_vectors(letter, self.dimensions), self.gram - 1 - k, axis=1)
            every = np.concatenate([self.codes, new])
            place = np.concatenate([self.place, len(self.vectors) + np.arange(len(new))])
            self.vectors = np.concatenate([self.vectors, made])
            order = np.argsort(every)
            self.codes, self.place = every[order], place[order]
            at = np.searchsorted(self.codes, codes)
        return self.place[at]

    def vector(self, text: str | None) -> np.ndarray | None:
        """The unit vector of a text, or None without letters."""
        codes, counts = self.grams(text or "")
        if not len(codes):
            return None
        total = np.zeros(self.dimensions, np.float32)
        where = self.rows(codes)
        for a in range(0, len(where), 4096):
            total += counts[a:a + 4096].astype(np.float32) @ self.vectors[where[a:a + 4096]].astype(np.float32)
        norm = np.linalg.norm(total)
        return total / norm if norm else None


def prototypes(training: DataFrame, text_col: str = "text", lang_col: str = "lang",
               dimensions: int = DIMENSIONS, gram: int = GRAM) -> DataFrame:
    """``(lang, vector)``: one bundled vector of ``dimensions`` integers for each language of the rows."""
    def bundle(batches):
        profiles, sums = Profiles(dimensions, gram), {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                unit = profiles.vector(text)
                if unit is not None:
                    if lang not in sums:
                        sums[lang] = np.zeros(dimensions, np.int64)
                    sums[lang] += np.rint(unit * SCALE).astype(np.int64)
        langs = list(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.array(langs, dtype=object), dimensions), pa.string()),
             pa.array(np.tile(np.arange(dimensions, dtype=np.int32), len(langs))),
             pa.array(np.concatenate([np.zeros(0, np.int64), *sums.values()]))], ["lang", "at", "value"])

    rows = training.filter(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    sums = rows.mapInArrow(bundle, "lang string, at int, value bigint").groupBy("lang", "at").agg(F.sum("value").alias("value"))
    return (sums.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("v"))
            .select("lang", F.col("v.value").alias("vector")))


def predict_language(learned: DataFrame, text: Column, dimensions: int = DIMENSIONS, gram: int = GRAM) -> Column:
    """Struct ``(lang_pred, score)`` of a text; score is the cosine, at least 0.

    ``learned`` has one row of ``dimensions`` numbers for each language, which
    is all that is collected: it grows with the number of languages alone.
    """
    known = {r["lang"]: np.array(r["vector"], np.float64) for r in learned.collect()}
    langs = sorted(k for k, v in known.items() if v.any())
    matrix = np.array([known[k] / np.linalg.norm(known[k]) for k in langs], np.float32).reshape(len(langs), dimensions)

    @F.arrow_udf("struct<lang_pred string, score double>")
    def predict(column: pa.Array) -> pa.Array:
        profiles, found, scores = Profiles(dimensions, gram), [], []
        for text in column.to_pylist():
            unit = profiles.vector(text) if langs else None
            if unit is None:
                found.append(UNKNOWN)
                scores.append(0.0)
                continue
            cosines = matrix @ unit
            best = int(cosines.argmax())
            found.append(langs[best])
            scores.append(float(min(max(cosines[best], 0.0), 1.0)))
        return pa.StructArray.from_arrays([pa.array(found, pa.string()), pa.array(scores, pa.float64())],
                                          ["lang_pred", "score"])
    return predict(text)


def is_near(text: Column, score: Column) -> Column:
    """Whether a text's score is beyond what random letters reach at its length; letters count with single spaces between words."""
    letters = F.length(F.trim(F.regexp_replace(text, r"[^\p{L}]+", " ")))
    least = F.lit(BOUNDS[0][1])
    for at, bound in BOUNDS[1:]:
        least = F.when(letters >= at, bound).otherwise(least)
    return score >= least


def held_out(id_col: str, parts: int, rest: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder (a null id does not)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == rest, F.lit(False))

"""Language identification with hyperdimensional profiles.

Every letter has a fixed random vector of +1 and -1. A trigram of letters is its
letters' vectors, shifted by their place, multiplied component by component; the
vectors of a text's trigrams are added to the vector of the text. A language's
prototype is the sum of the unit vectors of its training texts. What all prototypes
have in common tells nothing, so their mean is taken off before a text is compared
with each of them by cosine.

Letters are the alphabetic characters of any script, in lower case; everything else
separates words. Prototypes are summed as whole numbers, so the result does not
depend on how rows are spread over tasks. Tasks hold one vector per language and
letter; one vector per language and task is shuffled, as numbers that Spark adds up.

Null texts and texts without a letter are ``und`` with score 0, and so is every text
when there is nothing to learn from. Ties go to the language that sorts first.
Languages are expected to be a label set: their prototypes are held by every task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import id_remainder, map_batches
from gaugeworks.llm.encoding import chunks

DIMENSIONS = 1024
UNIT = 1 << 20
UNKNOWN = "und"


class Bundler:
    """Vectors of texts. Letter vectors come from the letter's code, so all tasks agree."""

    def __init__(self, dimensions: int = DIMENSIONS):
        self.dimensions = dimensions
        self.letters: dict[int, np.ndarray] = {}
        self.codes = np.zeros(0x110000, np.int32)  # code point -> 1 + code of its letter, 0: no letter
        self.seen = np.zeros(0x110000, bool)
        self.seen_here = np.zeros(0x110001, bool)
        self.rank = np.zeros(0x110001, np.int64)

    def letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            bits = np.random.Generator(np.random.PCG64(code)).integers(0, 2, self.dimensions, np.int8)
            self.letters[code] = bits * 2 - 1
        return self.letters[code]

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        """Unit vectors, zero for texts without letters."""
        points = [np.frombuffer((t or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
        owner = np.repeat(np.arange(len(texts)), [len(p) + 1 for p in points])
        stream = np.concatenate([np.append(p, 0) for p in points])
        for point in np.unique(stream[~self.seen[stream]]).tolist():
            self.seen[point] = True
            self.codes[point] = point + 1 if chr(point).isalpha() else 0
        codes = self.codes[stream]
        keep = codes > 0
        keep[:-1] |= keep[1:]  # of several separators the last, before a letter
        keep[1:] |= codes[:-1] > 0  # and the first, after a letter
        codes, owner = codes[keep], owner[keep]
        out = np.zeros((len(texts), self.dimensions), np.float32)
        middle = np.flatnonzero(codes > 0)
        if not len(middle):
            return out
        # letters of a text are apart from those of the next by a separator
        padded = np.concatenate(([0], codes, [0]))
        self.seen_here[padded] = True
        kinds = np.flatnonzero(self.seen_here)
        self.seen_here[kinds] = False
        self.rank[kinds] = np.arange(len(kinds))
        size = len(kinds)
        if len(texts) > 1 and len(texts) * size**3 >= 1 << 63:
            half = len(texts) // 2
            return np.concatenate([self(texts[:half]), self(texts[half:])])
        small = self.rank[padded]
        grams = (small[middle] * size + small[middle + 1]) * size + small[middle + 2]
        pairs, counts = np.unique(owner[middle] * size**3 + grams, return_counts=True)
        text, grams = np.divmod(pairs, size**3)
        gram_kinds, gram = np.unique(grams, return_inverse=True)
        basis = np.stack([self.letter(int(k)) for k in kinds])
        first, rest = np.divmod(gram_kinds, size * size)
        vectors = np.roll(basis, 2, 1)[first] * np.roll(basis, 1, 1)[rest // size] * basis[rest % size]
        vectors = vectors.astype(np.float32)
        found, begin = np.unique(text, return_index=True)
        for k, a, b in zip(found.tolist(), begin.tolist(), [*begin[1:].tolist(), len(text)], strict=True):
            out[k] = counts[a:b].astype(np.float32) @ vectors[gram[a:b]]
        out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-30)
        return out


def learn(
    documents: DataFrame, lang: str = "lang", text: str = "text", dimensions: int = DIMENSIONS
) -> dict[str, np.ndarray]:
    """Prototype per language, from the rows whose language is not null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundler = Bundler(dimensions)
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            at = 0
            for run in chunks(texts):
                vectors = np.rint(bundler(run) * UNIT).astype(np.int64)
                names = np.array(langs[at : at + len(run)], object)
                for name in set(names):
                    sums[name] = sums.get(name, 0) + vectors[names == name].sum(0)
                at += len(run)
        for name, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * dimensions, "string"),
                    pa.array(np.arange(dimensions, dtype=np.int32)),
                    pa.array(total),
                ],
                ["lang", "dimension", "value"],
            )

    source = documents.select(F.col(lang).cast("string").alias("lang"), text).where(
        "lang is not null"
    )
    rows = (
        source.mapInArrow(run, "lang string, dimension int, value long")
        .groupBy("lang", "dimension")
        .agg(F.sum("value").alias("value"))
        .collect()  # one vector per language
    )
    prototypes = {name: np.zeros(dimensions) for name in sorted({r.lang for r in rows})}
    for r in rows:
        prototypes[r.lang][r.dimension] = r.value
    return {k: v for k, v in prototypes.items() if v.any()}


def predict(
    documents: DataFrame,
    prototypes: dict[str, np.ndarray],
    columns: dict[str, Column],
    text: str = "text",
    dimensions: int = DIMENSIONS,
) -> DataFrame:
    """``columns`` of every row with ``lang_pred`` and ``score``."""
    names, given = list(prototypes), list(columns)
    units = np.stack([v / np.linalg.norm(v) for v in prototypes.values()]) if names else np.zeros((0, dimensions))
    common = units.mean(0) if len(names) > 1 else np.zeros(dimensions)
    apart = units - common
    apart /= np.maximum(np.linalg.norm(apart, axis=1, keepdims=True), 1e-30)

    def function():
        bundler = Bundler(dimensions)

        def convert(batch: pa.RecordBatch) -> dict:
            found, scores = [], []
            for run in chunks(batch.column(batch.num_columns - 1).to_pylist()):
                vectors = bundler(run)
                known = vectors.any(1)
                if not names:
                    found += [UNKNOWN] * len(run)
                    scores += [0.0] * len(run)
                    continue
                centred = vectors - common
                cosine = centred @ apart.T / np.maximum(np.linalg.norm(centred, axis=1, keepdims=True), 1e-30)
                best = cosine.argmax(1)
                found += [names[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
                score = np.clip((1 + cosine.max(1)) / 2, 0, 1)
                scores += np.where(known, score, 0.0).tolist()
            kept = {n: batch.column(i) for i, n in enumerate(given)}
            return kept | {"lang_pred": found, "score": scores}

        return convert

    source = documents.select(*[c.alias(n) for n, c in columns.items()], F.col(text).alias("_text"))
    kinds = ", ".join(f"{n} {source.schema[n].dataType.simpleString()}" for n in columns)
    return map_batches(source, function, f"{kinds}, lang_pred string, score double")


def identify(documents: DataFrame) -> DataFrame:
    """Language of every document, learnt from those whose id hash modulo 4 is not 2."""
    held_out = id_remainder(F.col("doc_id"), 4) == 2
    prototypes = learn(documents.where(~held_out))
    return predict(
        documents, prototypes, {"doc_id": F.col("doc_id"), "held_out": held_out}
    )

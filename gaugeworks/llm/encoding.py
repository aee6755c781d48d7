"""BPE encoding and decoding through a table of distinct words.

White space never lies inside a token of the vocabularies this is made for, so the
ids of a text are those of its words in order. A task keeps a table with one entry
per distinct word, encodes a word when it first meets it, and joins the ids back by
position. Decoding goes through a table from id to piece in the same way.

The tables are cleared when they reach ``max_words``, so a task's memory is bounded;
a word met again is then encoded again, with the same result. Nothing is shuffled:
joining every position of every text to one table of all words would move several
times the input (figures in the README).

Null and empty texts have no ids and decode to an empty text. Repeated rows are kept.
"""

from __future__ import annotations

import hashlib
import json
import os
from array import array
from itertools import pairwise
from operator import add

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import map_batches

VOCABULARY = "word_bpe_49k.json"
MAX_WORDS = 500_000
#: Punctuation of ASCII without the apostrophe.
TAIL = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def vocabulary_path(name: str = VOCABULARY) -> str:
    return public_tokenizers.path(name)


_CASE_AND_FORMS = {"NFC", "NFD", "NFKC", "NFKD", "Lowercase"}
_WHITE_PATTERN = {"Regex": r"\s+"}
#: Steps of a pre-tokenizer that leaves runs of ASCII letters whole and drops spaces between them.
_LETTERS_WHOLE = [
    {
        "type": "Split",
        "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
        "behavior": "Removed",
        "invert": True,
    },
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]


def _steps(part) -> list[dict]:
    """The steps of a normalizer or pre-tokenizer in order, as its own JSON describes them."""
    if part is None:
        return []
    step = json.loads(part.__getstate__())
    return step["normalizers" if "normalizers" in step else "pretokenizers"] if step["type"] == "Sequence" else [step]


class WordTable:
    """Ids (little-endian unsigned 32-bit) of the words met so far, and the text of such ids.

    Arrow splits texts and numbers their distinct words, so Python sees a word once in a
    call and not at every position. Most new words are a run of letters and some
    punctuation, one pre-token each, and many share the run, so runs have a table of
    their own. Unknown runs are encoded many at a time, apart by spaces: a piece that
    ends a word then ends a run. Runs of ASCII letters skip a normalizer that changes at
    most their case and a pre-tokenizer that parts them at spaces only; the case is
    changed here, so runs that differ in it only are encoded once.
    """

    def __init__(self, path: str, max_words: int = MAX_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.pieces = {i: p.encode() for p, i in vocabulary.items()}
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends[[i for p, i in vocabulary.items() if p.endswith("</w>")]] = True
        steps = _steps(self.tokenizer.normalizer)
        # what these steps do to letters of ASCII is known, so such runs need no normalizer
        self.plain = all(s["type"] in _CASE_AND_FORMS or s.get("pattern") == _WHITE_PATTERN for s in steps)
        self.lower = any(s["type"] == "Lowercase" for s in steps)
        self.spaced = _steps(self.tokenizer.pre_tokenizer) == _LETTERS_WHOLE
        self.at_spaces = CharDelimiterSplit(" ")
        self.letters = regex.compile(r"\p{L}+").fullmatch
        self.max_words = max_words
        self.words: dict[bytes, bytes] = {}
        self.runs: dict[bytes, bytes] = {}
        self.texts: dict[bytes, bytes] = {}

    def look_up(self, texts: pa.Array) -> tuple[pa.Array, pa.Array, list[bytes]]:
        """Where each text's words begin, the numbers of the words, and the ids by number.

        White space at the ends of a text gives empty words, which have no ids.
        """
        split = pc.ascii_split_whitespace(texts.fill_null(""))
        for table in (self.words, self.runs, self.texts):
            if len(table) > self.max_words:
                table.clear()
        numbered = split.values.dictionary_encode()
        words = _bytes(numbered.dictionary)
        found = list(map(self.words.get, words))
        if None in found:
            self.add([word for word, ids in zip(words, found, strict=True) if ids is None])
            found = list(map(self.words.__getitem__, words))
        return split.offsets, numbered.indices, found

    def ids(self, texts: list[str | None] | pa.Array) -> list[list[bytes]]:
        """For each text, the ids of its words that have any, by position."""
        begins, numbers, found = self.look_up(texts if isinstance(texts, pa.Array) else pa.array(texts, "string"))
        each = list(map(found.__getitem__, numbers.to_numpy().tolist()))
        spans = pairwise(begins.to_numpy().tolist())
        if b"" in found:
            return [[i for i in each[a:b] if i] for a, b in spans]
        return [each[a:b] for a, b in spans]

    def whole_ids(self, texts: pa.Array) -> list[bytes]:
        """For each text, all its ids together."""
        begins, numbers, found = self.look_up(texts)
        each = pa.array(found, "large_binary").take(numbers)
        return _bytes(pc.binary_join(pa.ListArray.from_arrays(begins, each), pa.scalar(b"", "large_binary")))

    def decoded(self, ids: list[bytes]) -> bytes:
        """The text of the ids of consecutive words: their pieces, apart by spaces."""
        known, pieces = self.texts, self.pieces
        for i in set(ids).difference(known):
            known[i] = b" ".join([pieces[k] for k in array("I", i)])
        return b" ".join(map(known.__getitem__, ids))

    def add(self, words: list[bytes]) -> None:
        """Take up new distinct words; runs are looked at once each, however many words share them."""
        runs = [word.rstrip(TAIL) for word in words]
        mixed = {run for run in runs if not run.isalpha()}
        mixed = {run for run in mixed if not self.letters(run.decode())}
        alone = {word for word, run in zip(words, runs, strict=True) if run in mixed}
        if alone:
            runs = [word if run in mixed else run for word, run in zip(words, runs, strict=True)]
        tails = [word[len(run) :] for word, run in zip(words, runs, strict=True)]
        if self.plain and self.lower:
            runs = [run.lower() if run.isalpha() else run for run in runs]
        known = self.runs
        known[b""] = b""
        new = set(runs).union(tails).difference(known)
        ascii_runs = [run for run in new if run.isalpha()] if self.plain else []
        kept = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        if ascii_runs:
            self.tokenizer.normalizer = None
            if self.spaced:
                self.tokenizer.pre_tokenizer = self.at_spaces
            self.encode_runs(ascii_runs)
            self.tokenizer.normalizer, self.tokenizer.pre_tokenizer = kept
        self.encode_runs(list(new.difference(alone, ascii_runs)))
        self.encode_each(list(new.intersection(alone)))
        found = map(add, map(known.__getitem__, runs), map(known.__getitem__, tails))
        self.words.update(zip(words, found, strict=True))

    def encode_each(self, runs: list[bytes]) -> None:
        texts = [run.decode() for run in runs]
        for run, found in zip(
            runs, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True
        ):
            self.runs[run] = array("I", found.ids).tobytes()

    def encode_runs(self, runs: list[bytes], together: int = 200) -> None:
        groups = [runs[i : i + together] for i in range(0, len(runs), together)]
        encoded = self.tokenizer.encode_batch_fast(
            [b" ".join(g).decode() for g in groups], add_special_tokens=False
        )
        for group, found in zip(groups, encoded, strict=True):
            ids = np.array(found.ids, "<u4")
            ends = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
            if len(ends) == len(group):
                whole = ids.tobytes()
                self.runs.update(
                    zip(group, [whole[a:b] for a, b in pairwise([0, *ends])], strict=True)
                )
            else:  # lower case can split a letter into a letter and a mark
                self.encode_each(group)


def _bytes(column: pa.Array) -> list[bytes]:
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_numpy(zero_copy_only=False).tolist()


def chunks(texts: list[str | None], characters: int = 4_000_000):
    """Consecutive runs of texts of limited length, so one task holds few words at a time."""
    run, size = [], 0
    for text in texts:
        run.append(text)
        size += len(text or "")
        if size >= characters:
            yield run
            run, size = [], 0
    if run:
        yield run


def text_slices(texts: pa.Array, size: int = 4_000_000):
    """As ``chunks``, for texts that stay in Arrow; the limit is one of bytes."""
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = done = 0
    while at < len(texts):
        stop = min(int(np.searchsorted(ends, done + size)) + 1, len(texts))
        yield texts.slice(at, stop - at)
        at, done = stop, int(ends[stop - 1])


def encode(
    documents: DataFrame,
    path: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    max_words: int = MAX_WORDS,
) -> DataFrame:
    """(id, ids, decoded): ids as packed little-endian unsigned 32-bit integers, decoded as UTF-8."""
    path = path or vocabulary_path()
    source = documents.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))

    def function():
        table = WordTable(path, max_words)

        def convert(batch: pa.RecordBatch) -> dict:
            ids, decoded = [], []
            for run in text_slices(batch.column(1)):
                for found in table.ids(run):
                    ids.append(b"".join(found))
                    decoded.append(table.decoded(found))
            return {"id": batch.column(0), "ids": ids, "decoded": decoded}

        return convert

    kind = source.schema["id"].dataType.simpleString()
    return map_batches(source, function, f"id {kind}, ids binary, decoded binary")


def digests(documents: DataFrame, path: str | None = None, max_words: int = MAX_WORDS) -> DataFrame:
    """Per document: number of ids and SHA-256 of ids and decoded text.

    The digests are taken in the same task, so ids and texts never leave it.
    """
    path = path or vocabulary_path()

    def function():
        table = WordTable(path, max_words)

        def convert(batch: pa.RecordBatch) -> dict:
            counts, ids_sha, decoded_sha = [], [], []
            for run in text_slices(batch.column(1)):
                for found in table.ids(run):
                    ids, decoded = b"".join(found), table.decoded(found)
                    counts.append(len(ids) // 4)
                    ids_sha.append(hashlib.sha256(ids).hexdigest())
                    decoded_sha.append(hashlib.sha256(decoded).hexdigest())
            return {
                "doc_id": batch.column(0),
                "n_tokens": counts,
                "ids_sha256": ids_sha,
                "decoded_sha256": decoded_sha,
            }

        return convert

    kind = documents.schema["doc_id"].dataType.simpleString()
    return map_batches(
        documents.select("doc_id", "text"),
        function,
        f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )

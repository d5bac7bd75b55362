"""BPE encoding and decoding through a minimal acyclic transducer of frequent words.

The lexicon is an automaton whose paths spell frequent words in UTF-8. Suffixes are shared, and the numbers on
a word's arcs add up to its index, which leads to its token ids. It is one flat file that tasks memory-map.
Words that it lacks are merged by rank, all words of a batch side by side. The result is what the tokenizers
library gives for a vocabulary file of BPE with word ends: NFC, white space as one space, lower case, splits,
byte letters, merges.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
import sys
import tempfile
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meetmart.llm.texts import UNICODE_SPACE, id_and_text, in_tasks, most_frequent
from meetmart.sources.scratch import materialized

#: Words that the lexicon holds at most; the file is then a few megabytes.
LEXICON_WORDS = 1 << 17
#: How often a word has to occur to be a candidate.
LEAST_COUNT = 8
#: Distinct words that a task counts before it hands on what it has.
_FLUSH = 200_000
#: Length of the texts that a task encodes side by side; each of their distinct words is looked up once.
_BLOCK_BYTES = 6_000_000
_END = "</w>"


class Specials(dict):
    """Ids of special tokens by their text, and what all the texts begin with."""

    def __init__(self, ids: dict[str, int]):
        super().__init__(ids)
        self.mark = os.path.commonprefix(list(ids))


class Vocabulary:
    """Ids, merges and special tokens of a vocabulary file of BPE with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        ids = model["vocab"]
        self.special = Specials({t["content"]: t["id"] for t in spec["added_tokens"]})
        shown = {v: k for k, v in ids.items()} | {v: k for k, v in self.special.items()}
        self.shown = [shown.get(k, "").encode() for k in range(max(shown) + 1)]
        letters = _byte_letters()
        self.inner = np.array([ids[letters[b]] for b in range(256)], np.int64)
        self.last = np.array([ids[letters[b] + _END] for b in range(256)], np.int64)
        pairs, made = [], []
        for merge in model["merges"]:
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            pairs.append(ids[left] << 20 | ids[right])
            made.append(ids[left + right])
        rank = {}
        for k, pair in enumerate(pairs):
            rank[pair] = k  # as in the library, the last of equal merges counts
        order = sorted(rank)
        self.pair = np.array(order, np.int64)
        self.pair_rank = np.array([rank[p] for p in order], np.int64)
        self.made = np.array(made, np.int64)

    def merged(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words, one after the other, and where each word's begin.

        In each round the best pair of every word is merged wherever it stands in that word, from the left.
        """
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        tokens = self.inner[raw]
        ends = np.cumsum(sizes)
        tokens[ends - 1] = self.last[raw[ends - 1]]
        word = np.repeat(np.arange(len(words)), sizes)
        done_tokens, done_word = [], []
        none = len(self.pair) + 1
        while len(tokens):
            rank = np.full(len(tokens), none, np.int64)  # of the pair that starts here
            key = tokens[:-1] << 20 | tokens[1:]
            at = np.searchsorted(self.pair, key)
            at[at == len(self.pair)] = 0
            hit = (self.pair[at] == key) & (word[:-1] == word[1:])
            rank[:-1][hit] = self.pair_rank[at[hit]]
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            spans = np.diff(np.r_[first, len(word)])
            best = np.repeat(np.minimum.reduceat(rank, first), spans)
            over = best == none
            if over.any():
                done_tokens.append(tokens[over])
                done_word.append(word[over])
            join = (rank == best) & ~over
            join = _no_overlap(join)
            tokens[join] = self.made[rank[join]]
            keep = ~over
            keep[1:] &= ~join[:-1]
            tokens, word = tokens[keep], word[keep]
        tokens, word = np.concatenate(done_tokens), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        return tokens[order], np.r_[0, np.cumsum(np.bincount(word, minlength=len(words)))]


def _no_overlap(join: np.ndarray) -> np.ndarray:
    """In a run of neighbouring starts only the first, third, ... merge."""
    if not (join[1:] & join[:-1]).any():
        return join
    at = np.flatnonzero(join)
    fresh = np.r_[True, np.diff(at) != 1]
    run = at[np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))]
    join = join.copy()
    join[at[(at - run) % 2 == 1]] = False
    return join


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 as it is, others from U+0100 on in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


# Texts to words


@functools.cache
def _patterns() -> tuple[re.Pattern, re.Pattern]:
    """White space, and the words of normalized text (contractions, letters, one number, other signs)."""

    def ranges(kind: str) -> str:
        out, start = [], None
        for c in range(sys.maxunicode + 2):
            inside = c <= sys.maxunicode and unicodedata.category(chr(c))[0] == kind
            if inside and start is None:
                start = c
            elif not inside and start is not None:
                out.append(f"\\U{start:08x}-\\U{c - 1:08x}")
                start = None
        return "".join(out)

    letters, numbers = ranges("L"), ranges("N")
    return re.compile(f"[{UNICODE_SPACE}]+"), re.compile(
        rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{UNICODE_SPACE}{letters}{numbers}]+"
    )


def chunks(text: str) -> list[str]:
    """Parts of a text between white space; no step below looks across it."""
    if _CONTROLS.search(text):  # white space for str.split alone
        return [x for x in _patterns()[0].split(text) if x]
    return text.split()


_CONTROLS = re.compile("[\x1c-\x1f]")


def split_words(text: str) -> list[str]:
    """Words of a text after NFC and lower case letter by letter (a final sigma as any other)."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
    return _patterns()[1].findall(text.lower())


@functools.lru_cache(maxsize=4)
def _special_pattern(names: tuple[str, ...]) -> re.Pattern:
    return re.compile("(" + "|".join(map(re.escape, sorted(names, key=len, reverse=True))) + ")")


def words_and_specials(chunk: str, special: Specials) -> list[str | int]:
    """Words, and ids of special tokens that stand in the text."""
    if not special or special.mark not in chunk:
        return split_words(chunk)
    out: list[str | int] = []
    for part in _special_pattern(tuple(special)).split(chunk):
        out += [special[part]] if part in special else split_words(part)
    return out


# The transducer


class Builder:
    """Minimal automaton of words that come in ascending order."""

    def __init__(self):
        self.register: dict[tuple, int] = {}
        self.arcs: list[tuple] = []  # of a finished state: (final, ((byte, target), ...))
        self.path: list[list] = [[False, []]]
        self.last = b""

    def add(self, word: bytes) -> None:
        same = len(os.path.commonprefix([word, self.last]))
        self._finish(same)
        for byte in word[same:]:
            self.path[-1][1].append([byte, -1])
            self.path.append([False, []])
        self.path[-1][0] = True
        self.last = word

    def _finish(self, depth: int) -> None:
        while len(self.path) > depth + 1:
            state = self.path.pop()
            self.path[-1][1][-1][1] = self._number(state)

    def _number(self, state: list) -> int:
        key = (state[0], tuple(map(tuple, state[1])))
        if key not in self.register:
            self.register[key] = len(self.arcs)
            self.arcs.append(key)
        return self.register[key]

    def arrays(self) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Root, arc keys (state and byte), targets, numbers on arcs, final states."""
        self._finish(0)
        root = self._number(self.path[0])
        below = []  # words from a state on; targets come first
        key, target, weight = [], [], []
        for state, (final, arcs) in enumerate(self.arcs):
            total = int(final)
            for byte, to in arcs:
                key.append(state << 8 | byte)
                target.append(to)
                weight.append(total)
                total += below[to]
            below.append(total)
        final = np.array([f for f, _ in self.arcs], np.int64)
        return root, *(np.array(x, np.int64) for x in (key, target, weight)), final


def compile_lexicon(words: list[bytes], vocabulary: Vocabulary) -> bytes:
    """A flat file of int64: header, arc keys, targets, numbers, finals, starts of ids, ids."""
    words = sorted(set(words) - {b""})
    builder = Builder()
    for word in words:
        builder.add(word)
    root, key, target, weight, final = builder.arrays()
    ids, starts = vocabulary.merged(words) if words else (np.zeros(0, np.int64), np.zeros(1, np.int64))
    head = np.array([root, len(key), len(final), len(words)], np.int64)
    return b"".join(x.astype("<i8").tobytes() for x in (head, key, target, weight, final, starts, ids))


class Lexicon:
    """A memory-mapped transducer."""

    def __init__(self, path: str):
        flat = np.memmap(path, "<i8", "r")
        self.root, arcs, states, words = (int(x) for x in flat[:4])
        cuts = np.cumsum([4, arcs, arcs, arcs, states, words + 1])
        self.key, self.target, self.weight, self.final, self.starts, self.ids = (
            flat[a:b] for a, b in zip(cuts, [*cuts[1:], len(flat)])
        )

    def index(self, words: list[bytes]) -> np.ndarray:
        """Each word's index, -1 for words that are not there; all words take a step at a time."""
        index = np.full(len(words), -1, np.int64)
        if not len(self.key) or not words:
            return index
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.r_[0, np.cumsum(sizes)[:-1]]
        raw = np.frombuffer(b"".join(words), np.uint8)
        who, state, total = np.arange(len(words)), np.full(len(words), self.root), np.zeros(len(words), np.int64)
        step = 0
        while len(who):
            ended = sizes[who] == step
            accepted = ended & (self.final[state] == 1)
            index[who[accepted]] = total[accepted]
            who, state, total = who[~ended], state[~ended], total[~ended]
            wanted = state << 8 | raw[starts[who] + step]
            at = np.searchsorted(self.key, wanted)
            at[at == len(self.key)] = 0
            there = self.key[at] == wanted
            who, at = who[there], at[there]
            state, total = self.target[at], total[there] + self.weight[at]
            step += 1
        return index


_opened: dict[str, object] = {}


def _open(kind, path: str):
    """One open file per worker process."""
    if path not in _opened:
        _opened[path] = kind(path)
    return _opened[path]


# On Spark


def word_counts(docs: DataFrame, special: Specials) -> DataFrame:
    """How often each word occurs in all texts; tasks add up their own before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def counted() -> pa.RecordBatch:
            counts: Counter = Counter()
            for chunk, n in seen.items():
                for word in words_and_specials(chunk, special):
                    if type(word) is str:
                        counts[word] += n
            seen.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                names=["word", "n"],
            )

        for batch in batches:
            for text in batch.column("text").to_pylist():
                seen.update(chunks(text or ""))
                if len(seen) > _FLUSH:
                    yield counted()
        yield counted()

    return in_tasks(docs, run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(
    docs: DataFrame, tokenizer: str, size: int = LEXICON_WORDS, least: int = LEAST_COUNT
) -> str:
    """Compiles the most frequent words of all texts and hands the file to all executors.

    The driver gets `size` words at most. Returns the name under which tasks find the file.
    """
    spark = docs.sparkSession
    vocabulary = Vocabulary(tokenizer)
    counts = materialized(word_counts(docs.select("text"), vocabulary.special), "words")
    frequent = most_frequent(counts, size, least)
    packed = compile_lexicon([word.encode() for word, _ in frequent], vocabulary)
    folder = tempfile.mkdtemp(prefix="lexicon-")  # only the driver reads it; addFile carries it on
    path = os.path.join(folder, f"{hashlib.sha256(packed).hexdigest()[:24]}-{os.path.basename(folder)}.bin")
    with open(path, "wb") as file:
        file.write(packed)
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def encode(docs: DataFrame, tokenizer: str, lexicon: str, with_text: bool = False) -> DataFrame:
    """(doc_id, ids) per row, ids as little-endian unsigned 32-bit integers; `with_text` adds them decoded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _open(Vocabulary, tokenizer)
        words = _open(Lexicon, SparkFiles.get(lexicon))

        def encoded(docs: list[int | None], texts: list[str]) -> pa.RecordBatch:
            ids = encode_block(texts, vocabulary, words)
            columns = [pa.array(docs, pa.int64()), pa.array(ids, pa.binary())]
            if with_text:
                columns.append(pa.array([decode(x, vocabulary) for x in ids], pa.binary()))
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"][: len(columns)])

        docs, texts, size = [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                docs.append(doc)
                texts.append(text or "")
                size += len(texts[-1])
                if size >= _BLOCK_BYTES:
                    yield encoded(docs, texts)
                    docs, texts, size = [], [], 0
        if docs:
            yield encoded(docs, texts)

    return in_tasks(docs, run, "doc_id bigint, ids binary" + ", decoded binary" * with_text)


def encode_block(texts: list[str], vocabulary: Vocabulary, lexicon: Lexicon) -> list[bytes]:
    """Ids of some texts: each distinct word is looked up once, and those not found are merged."""
    part_number: dict[str, int] = {}
    places = []
    for text in texts:
        found = chunks(text)
        places.append(
            np.fromiter((part_number.setdefault(c, len(part_number)) for c in found), np.int64, len(found))
        )
    number: dict[str | int, int] = {}
    inside, counts = [], []
    for part in part_number:
        found = words_and_specials(part, vocabulary.special)
        inside += [number.setdefault(w, len(number)) for w in found]
        counts.append(len(found))
    words = list(number)
    distinct = [w.encode() if type(w) is str else b"" for w in words]
    index = lexicon.index(distinct)
    starts, sizes = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    known = index >= 0
    starts[known] = lexicon.starts[index[known]]
    sizes[known] = lexicon.starts[index[known] + 1] - starts[known]
    pool = [np.asarray(lexicon.ids)]
    unseen = [k for k in np.flatnonzero(~known).tolist() if distinct[k]]
    if unseen:
        ids, cuts = vocabulary.merged([distinct[k] for k in unseen])
        starts[unseen], sizes[unseen] = cuts[:-1] + len(pool[0]), np.diff(cuts)
        pool.append(ids)
    for k, word in enumerate(words):
        if type(word) is int:
            starts[k], sizes[k] = sum(map(len, pool)), 1
            pool.append(np.array([word], np.int64))
    inside = np.array(inside, np.int64)
    by_part = _spans(np.concatenate(pool).astype("<u4"), starts[inside], sizes[inside])
    ends = np.r_[0, np.cumsum(sizes[inside])][np.r_[0, np.cumsum(np.array(counts, np.int64))]]
    return [_spans(by_part, ends[at], ends[at + 1] - ends[at]).tobytes() for at in places]


def _spans(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The spans of `pool`, one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return pool[np.arange(total) + np.repeat(starts - (ends - sizes), sizes)]


def decode(ids: bytes, vocabulary: Vocabulary) -> bytes:
    """The text in UTF-8: the file names no decoder, so tokens stand apart by a space."""
    return b" ".join([vocabulary.shown[k] for k in np.frombuffer(ids, "<u4").tolist()])


def decode_ids(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, decoded) of rows of `encode`; null ids are an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _open(Vocabulary, tokenizer)
        for batch in batches:
            texts = [decode(x or b"", vocabulary) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.binary())], names=["doc_id", "decoded"])

    return in_tasks(encoded.select("doc_id", "ids"), run, "doc_id bigint, decoded binary")


def encode_digest(docs: DataFrame, tokenizer: str, size: int = LEXICON_WORDS) -> DataFrame:
    """Number and digest of the ids and digest of the decoded text per row of `docs`.

    Null texts count as empty: no ids, and the digests of nothing. Repeated rows give repeated results.
    """
    docs = id_and_text(docs, "doc_id", "text")
    ids = encode(docs, tokenizer, build_lexicon(docs, tokenizer, size), with_text=True)
    return ids.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

"""Byte-level BPE as a deterministic automaton over tokens.

The automaton accepts exactly the token strings that the merges make of some
text. It begins with one state in which every byte may follow. Each merge
(u, v) -> w in turn adds a gadget:

* w leads wherever v led, and may follow wherever u may,
* after u there is no arc v any more; the state after u is split off first if
  other tokens lead to it as well.

So the state after a token depends on that token alone, and an arc is one bit of
a table of states by classes of tokens. A word is encoded by following arcs from
the start; every prefix of it has one accepted path, so no position is entered
twice. Decoding follows the ids and emits the labels of their arcs.

What is not the method's: a text is split into words as the vocabulary file
says, and words seen before keep their ids in a bounded store.

NULL and empty texts have no ids and decode to the empty text. Rows are
independent: repeated rows and equal or NULL doc_ids come out as often as they
come in, and other columns are never read. Texts are encoded whole; a word of
any length costs time in proportion to it times the longest token.
"""

from __future__ import annotations

import hashlib
import json
import pickle
import re
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the split that the vocabulary file names by its pre-tokenizer.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The same for texts below LATIN_END, by plain lists of their letters, numbers
# and white space, which is quicker.
LATIN_END = "\u02b0"
_LETTER, _NUMBER, _GAP = "A-Za-zªµºÀ-ÖØ-öø-ʯ", "0-9²³¹¼-¾", r"\t-\r \x85\xa0"
LATIN_SPLIT = (
    rf" ?[{_LETTER}]+|'(?:[stmd]|re|ve|ll)| ?[{_NUMBER}]+| ?[^{_GAP}{_LETTER}{_NUMBER}]+"
    rf"|[{_GAP}]+(?![^{_GAP}])|[{_GAP}]+"
)
WORDS_HELD = 400_000
LONGEST_HELD = 64
_BYTES = 256


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(_BYTES) if b not in shown]
    return {chr(b): b for b in shown} | {chr(_BYTES + i): b for i, b in enumerate(hidden)}


class _Table:
    """Bits of states by token classes, both of which grow by splitting."""

    def __init__(self, tokens: int):
        self.bits = np.ones((1024, 1024), bool)
        self.states = self.classes = 1
        self.state = np.full(tokens, -1, np.int32)  # where a token leads
        self.kind = np.full(tokens, -1, np.int32)  # its class as an arc
        self.leading = [1]  # tokens that lead to a state; the start counts as one
        self.alike = [0]  # tokens of a class

    def add(self, token: int, state: int, kind: int) -> None:
        self.state[token], self.kind[token] = state, kind
        self.leading[state] += 1
        self.alike[kind] += 1

    def gadget(self, u: int, v: int, made: int) -> None:
        """One merge: ``made`` takes the place of u before v."""
        leads = int(self.state[v])
        self.leading[leads] += 1  # so that it outlives the split where u is v
        self.forbid(u, v)
        self.leading[leads] -= 1
        self.add(made, leads, int(self.kind[u]))

    def may_follow(self, u: int, v: int) -> bool:
        return bool(self.bits[self.state[u], self.kind[v]])

    def forbid(self, u: int, v: int) -> None:
        """No v after u; every other pair stays as it is."""
        state, kind = int(self.state[u]), int(self.kind[v])
        if self.leading[state] > 1:
            if self.states == len(self.bits):
                self.bits = np.concatenate([self.bits, np.ones_like(self.bits)])
            self.bits[self.states] = self.bits[state]
            self.leading[state] -= 1
            self.leading.append(1)
            self.state[u] = state = self.states
            self.states += 1
        if self.alike[kind] > 1:
            if self.classes == self.bits.shape[1]:
                self.bits = np.concatenate([self.bits, np.ones_like(self.bits)], axis=1)
            self.bits[: self.states, self.classes] = self.bits[: self.states, kind]
            self.alike[kind] -= 1
            self.alike.append(1)
            self.kind[v] = kind = self.classes
            self.classes += 1
        self.bits[state, kind] = False


def build(labels: list[bytes], bases: list[int], merges: list[tuple[int, int, int]]) -> dict:
    """The automaton's tables, as plain values that travel to workers.

    ``labels`` are the bytes of every token, ``bases`` the one-byte tokens,
    ``merges`` the triples (u, v, uv) in order.
    """
    table = _Table(len(labels))
    for token in bases:
        table.add(token, 0, 0)
    named = set(bases)
    for u, v, made in merges:
        if u not in named or v not in named or made in named:
            raise ValueError(f"merge {u}, {v} uses a token that is not made yet, or makes one twice")
        named.add(made)
        # Tokens that earlier merges keep apart never meet, so this one makes nothing.
        if table.kind[u] < 0 or table.kind[v] < 0 or not table.may_follow(u, v):
            continue
        table.gadget(u, v, made)
    steps: dict = {}
    for token, label in enumerate(labels):
        if table.kind[token] < 0:
            continue
        node = steps
        for byte in label:
            node = node.setdefault(byte, {})
        place, bit = divmod(int(table.kind[token]), 8)
        node[_BYTES] = (token, place, bit, int(table.state[token]), len(label))
    packed = np.packbits(table.bits[: table.states, : table.classes], axis=1, bitorder="little")
    return {
        "arcs": [row.tobytes() for row in packed],
        "labels": labels,
        "steps": steps,  # by byte; a token's end has its arc under _BYTES
    }


def read_vocabulary(path: str) -> dict:
    """Tables of a byte-level BPE vocabulary file. Files with parts that this
    automaton does not know are refused rather than read wrongly."""
    with open(path, encoding="utf-8") as file:
        return vocabulary_tables(file.read(), path)


def vocabulary_tables(text: str, path: str = "vocabulary") -> dict:
    """The tables of ``read_vocabulary`` from the text of the file."""
    read = json.loads(text)
    model, before = read["model"], read["pre_tokenizer"] or {}
    odd = [
        k
        for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        if model.get(k)
    ]
    if (
        odd
        or read["normalizer"]
        or before.get("type") != "ByteLevel"
        or before.get("add_prefix_space")
        or not before.get("use_regex", True)
    ):
        raise ValueError(f"{path} is no plain byte-level BPE vocabulary: {odd or before or read['normalizer']}")
    letters, vocabulary = byte_letters(), model["vocab"]
    added = {t["content"]: t["id"] for t in read["added_tokens"]}
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in read["added_tokens"]):
        raise ValueError(f"{path} has added tokens that take their surroundings along")
    labels = [b""] * (max([*vocabulary.values(), *added.values()]) + 1)
    for token, number in vocabulary.items():
        if token not in added:
            labels[number] = bytes(letters[c] for c in token)
    for token, number in added.items():
        labels[number] = token.encode()
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    merges = [(vocabulary[u], vocabulary[v], vocabulary[u + v]) for u, v in pairs]
    bases = [vocabulary[c] for c in letters if c in vocabulary]
    if len(bases) < _BYTES:
        raise ValueError(f"{path} lacks some of the 256 byte tokens")
    return build(labels, bases, merges) | {"added": added, "file": text}


class Automaton:
    """Encodes and decodes with the tables of ``build`` or ``read_vocabulary``."""

    def __init__(self, tables: dict, specials: bool = True, held: int = WORDS_HELD):
        self.arcs, self.steps, self.labels = tables["arcs"], tables["steps"], tables["labels"]
        self.longest = max(map(len, self.labels), default=0)
        self.file, self.held = tables.get("file"), held
        self.added = tables.get("added", {}) if specials else {}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")") if self.added else None
        self.words, self.latin_words = regex.compile(SPLIT).findall, re.compile(LATIN_SPLIT).findall
        self.known: dict[str, bytes] = {}
        self.met: set[str] = set()
        self._splitter = None

    def path(self, word: bytes) -> list[int]:
        """Labels of the one accepted path that spells the word.

        The longest arc is tried first. A position is left for good once no arc
        leads on from it: whatever path reaches it again would be the same one.
        """
        n, arcs, longest = len(word), self.arcs, self.longest
        found: list[tuple] = []
        left: list[list[tuple]] = []  # arcs not tried yet, per arc found
        seen: set[int] = set()
        at = state = 0
        while at < n:
            row, node, tried = arcs[state], self.steps, []
            for byte in word[at : at + longest]:
                node = node.get(byte)
                if node is None:
                    break
                arc = node.get(_BYTES)
                if arc is not None and row[arc[1]] >> arc[2] & 1:
                    tried.append(arc)
            while not tried or at + tried[-1][4] in seen:
                if tried:
                    tried.pop()
                else:
                    at -= found.pop()[4]
                    tried = left.pop()
            arc = tried.pop()
            left.append(tried)
            found.append(arc)
            at += arc[4]
            seen.add(at)
            state = arc[3]
        return [arc[0] for arc in found]

    def _split(self, text: str) -> list[str]:
        """Words of a text. Letters newer than the interpreter's Unicode tables
        are classed by the tokenizer itself, as its tables may be another year's."""
        if max(text, default="") < LATIN_END:
            return self.latin_words(text)
        new = set(text) - self.met
        if new:
            if any(unicodedata.category(c) == "Cn" for c in new):
                if self._splitter is None:
                    from tokenizers import Tokenizer

                    self._splitter = Tokenizer.from_str(self.file).pre_tokenizer
                return [text[a:b] for _, (a, b) in self._splitter.pre_tokenize_str(text)]
            self.met |= new
        return self.words(text)

    def _plain(self, text: str) -> bytes:
        words, known = self._split(text), self.known
        new = set(words).difference(known)
        for word in new:
            known[word] = np.array(self.path(word.encode()), "<u4").tobytes()
        found = b"".join(map(known.__getitem__, words))
        for word in new:
            if len(word) > LONGEST_HELD:
                del known[word]
        if len(known) > self.held:
            self.known = {}
        return found

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text, as unsigned 32-bit numbers."""
        if self.cut is None or not any(map(text.__contains__, self.added)):
            return np.frombuffer(self._plain(text), "<u4")
        parts = (
            np.array([self.added[part]], "<u4").tobytes() if i % 2 else self._plain(part)
            for i, part in enumerate(self.cut.split(text))
        )
        return np.frombuffer(b"".join(parts), "<u4")

    def decode(self, ids) -> bytes:
        """Labels of the arcs that the ids name, in order."""
        return b"".join(map(self.labels.__getitem__, ids))


def _coded(tables):
    def run(batches):
        automaton = Automaton(tables.value)
        names = [str(i) for i in range(len(automaton.labels))]
        for batch in batches:
            n, ids, decoded = [], [], []
            for text in batch["text"].to_pylist():
                found = automaton.encode(text or "").tolist()
                n.append(len(found))
                ids.append(hashlib.sha256(",".join(map(names.__getitem__, found)).encode()).hexdigest())
                back = automaton.decode(found).decode("utf-8", "replace")
                decoded.append(hashlib.sha256(back.encode()).hexdigest())
            yield pa.record_batch(
                {
                    "doc_id": batch["doc_id"],
                    "n_tokens": pa.array(n, pa.int64()),
                    "ids_sha256": pa.array(ids, pa.string()),
                    "decoded_sha256": pa.array(decoded, pa.string()),
                }
            )

    return run


def _encoded(tables):
    def run(batches):
        automaton = Automaton(tables.value)
        for batch in batches:
            ids = [automaton.encode(text or "").astype(np.int32) for text in batch["text"].to_pylist()]
            yield pa.record_batch(
                {"doc_id": batch["doc_id"], "ids": pa.array(ids, pa.list_(pa.int32()))}
            )

    return run


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


class _Shipped:
    """The tables, pickled and broadcast; each process unpickles them once."""

    def __init__(self, blob, key: str):
        self.blob, self.key = blob, key

    @property
    def value(self) -> dict:
        key = self.key
        if key not in _BUILT:
            _BUILT.clear()
            _BUILT[key] = pickle.loads(self.blob.value)
        return _BUILT[key]


_BUILT: dict[str, dict] = {}


def shipped(docs: DataFrame, vocabulary: str):
    """The tables for all executors. They are as large as the vocabulary, some
    tens of MB pickled, whatever the corpus. The driver reads the file and
    broadcasts its text; one task builds the tables, hundreds of MB of Python
    objects, so the driver only holds them pickled."""
    with open(vocabulary, encoding="utf-8") as file:
        text = file.read()
    context = docs.sparkSession.sparkContext
    source = context.broadcast(text)

    def build_once(_):
        yield pickle.dumps(vocabulary_tables(source.value, vocabulary), protocol=pickle.HIGHEST_PROTOCOL)

    (blob,) = context.parallelize([0], 1).mapPartitions(build_once).collect()
    source.destroy()
    return _Shipped(context.broadcast(blob), hashlib.sha256(blob).hexdigest())


def encoded(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id and the ids of every whole text."""
    run = _encoded(shipped(docs, vocabulary))
    return _texts(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decoded(coded: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id and text of (doc_id, ids) rows; bytes that are no UTF-8 become the
    replacement character. NULL ids decode to the empty text."""
    tables = shipped(coded, vocabulary)

    def run(batches):
        automaton = Automaton(tables.value)
        for batch in batches:
            texts = [automaton.decode(ids or ()).decode("utf-8", "replace") for ids in batch["ids"].to_pylist()]
            yield pa.record_batch({"doc_id": batch["doc_id"], "text": pa.array(texts, pa.string())})

    return coded.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")).mapInArrow(
        run, "doc_id long, text string"
    )


def round_trip(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text."""
    run = _coded(shipped(docs, vocabulary))
    return _texts(docs).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )

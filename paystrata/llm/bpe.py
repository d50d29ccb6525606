"""Byte-pair encoding by a tokenization automaton, and decoding.

The automaton's states are tokens, its arcs are labelled by tokens, and an arc
from u to v exists when no merge joins across the border of u and v. Taking the
merges in order, merge (x, y) removes the arcs whose border has x on its left and
y on its right while both still stand as tokens of their own: that is one gadget
per merge. The gadgets of a border are its pieces' ranks along the right edge of
u and the left edge of v, so an arc is settled on its first use from the tables
of all merges and then read from the transition table.

A sequence of tokens is the encoding of its bytes if and only if all its arcs
exist. Every prefix has one encoding, so a word is encoded by following arcs from
longest label to shortest, and each position is visited once. Decoding takes the ids
alone and emits their labels.

Defined results: a null text is empty; an empty text has no tokens; the added
tokens of the file are split off first, as the library does; repeated rows get the
same result each; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from paystrata.llm.common import map_arrow

NEVER = 1 << 30
WORD_MEMORY = 200_000  # words remembered per Python worker
ARC_MEMORY = 500_000  # arcs remembered per Python worker
FLUSH = 1 << 18  # tokens after which a worker hands on the texts it has done
# Letters and numbers assigned after the Unicode version that the library
# was built with, which it takes for other characters.
NEWER = (
    r"\U00000558\U0000058b-\U0000058c\U0000088f\U00000c5c\U00000cdc\U0000208f"
    r"\U0000209d-\U0000209f\U0000a7ce-\U0000a7cf\U0000a7d2\U0000a7d4\U0000a7dd\U0000a7e2"
    r"\U0000a7f1\U0000ab6c-\U0000ab6d\U000107bb-\U000107bf\U00010940-\U00010959"
    r"\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a\U00011db0-\U00011ddb"
    r"\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f\U00012550-\U00012686"
    r"\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3\U00016ff2-\U00016ff3\U00016ff4-\U00016ff6"
    r"\U000187f8-\U000187ff\U00018cd6-\U00018cda\U00018d09-\U00018d20\U00018d80-\U00018df2"
    r"\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168\U0001d6a6"
    r"\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff"
    r"\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed"
    r"\U0001e6f0-\U0001e6f4\U0001e6fe-\U0001e6ff\U0002b73a-\U0002b73f\U0002b81e"
    r"\U0002cea2-\U0002cead\U000323b0-\U00033479\U0003d000-\U0003fc3f"
)
# The pattern of byte-level BPE that splits a text into words, and the same
# with NEWER moved. They differ only on texts that have such characters.
PLAIN_WORD = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
WORD = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[\p{L}--[" + NEWER + r"]]+| ?[\p{N}--[" + NEWER + r"]]+"
    r"| ?[[^\s\p{L}\p{N}]||[" + NEWER + r"]]+|\s+(?!\S)|\s+",
    regex.V1,
)
HAS_NEWER = re.compile("[" + "".join(NEWER) + "]")


# The letters, numbers and white space of Latin-1, and the pattern by them,
# which the standard library matches in half the time.
_L = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
_N = r"0-9\xb2\xb3\xb9\xbc-\xbe"
_S = r"\t-\r \x85\xa0"
LATIN_WORD = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+"
)


def split_words(text: str) -> list[str]:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return (WORD if HAS_NEWER.search(text) else PLAIN_WORD).findall(text)
    return LATIN_WORD.findall(text)


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in printable}
    rest = (b for b in range(256) if b not in set(printable))
    letters |= {chr(256 + n): b for n, b in enumerate(rest)}
    return letters


class Automaton:
    """Transition tables compiled from a file of the tokenizers library."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        vocabulary: dict[str, int] = spec["model"]["vocab"]
        self.label: dict[int, bytes] = {
            token: bytes(letters[c] for c in text) for text, token in vocabulary.items()
        }
        self.token = {label: token for token, label in self.label.items()}
        self.added = {entry["content"]: entry["id"] for entry in spec.get("added_tokens", [])}
        self.label |= {token: text.encode() for text, token in self.added.items()}
        self.longest = max(map(len, self.token), default=1)
        self.merge_rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair = vocabulary[left], vocabulary[right]
            made = vocabulary[left + right]
            self.merge_rank.setdefault(pair, rank)
            if made not in self.parts:
                self.parts[made], self.rank[made] = pair, rank
        self.arcs: dict[int, bool] = {}
        # when the first is full it takes the place of the second, so that words in use stay
        self.words: dict[str, str] = {}
        self.older_words: dict[str, str] = {}
        # labels that the merges make of their own bytes; no other token can be met
        self.own = {
            label: token for label, token in self.token.items()
            if len(label) == 1 or self._is_own_encoding(token)
        }
        Automaton._is_own_encoding.cache_clear()  # asked for here only
        self.trie, self.shorter, self.size = self._prefixes()
        added = "|".join(regex.escape(text) for text in sorted(self.added, key=len, reverse=True))
        self.split_added = regex.compile(f"({added})") if added else None

    def _prefixes(self) -> tuple[dict, array, array]:
        """The labels as nested dictionaries by byte, each with the longest label on its way under
        ``None``; by token the longest label that begins it, or -1; and by token its label's length.
        """
        count = max(self.label, default=-1) + 1
        trie, shorter, size = {None: -1}, array("i", [-1]) * count, array("i", [0]) * count
        for label, token in sorted(self.own.items()):
            node = trie
            for byte in label:
                before, node = node, node.setdefault(byte, {None: node[None]})
            node[None], shorter[token], size[token] = token, before[None], len(label)
        return trie, shorter, size

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """Pieces at one edge, with the rank at which each goes into the next larger one."""
        pieces = [(token, NEVER)]
        while token in self.parts:
            until = self.rank[token]
            token = self.parts[token][side]
            pieces.append((token, until))
        return pieces

    def arc(self, left: int, right: int) -> bool:
        """Whether the border between two tokens stays when all merges are done."""
        key = left << 20 | right
        known = self.arcs.get(key)
        if known is None:
            known = self._border_stays(left, right)
            if len(self.arcs) >= ARC_MEMORY:
                self.arcs.clear()
            self.arcs[key] = known
        return known

    def _border_stays(self, left: int, right: int) -> bool:
        for x, x_until in self._edge(left, 1):
            for y, y_until in self._edge(right, 0):
                at = self.merge_rank.get((x, y))
                # of equal merges the one further left is done first
                if at is not None and at < x_until and at <= y_until:
                    if at > self.rank.get(x, -1) and at > self.rank.get(y, -1):
                        return False
        return True

    def path(self, word: bytes) -> list[int]:
        """The tokens of a word: the only path of arcs that spells it."""
        whole = self.own.get(word)
        return self._path_with_steps_back(word) if whole is None else [whole]

    def _path_with_steps_back(self, word: bytes) -> list[int]:
        """The longest arc is followed first; where none leads on, the step before is shortened."""
        end, trie, longest, arcs = len(word), self.trie, self.longest, self.arcs.get
        shorter, size = self.shorter, self.size
        dead = bytearray(end + 1)
        tokens: list[int] = []
        start, last, token = 0, -1, -2
        while start < end:
            if token == -2:  # the longest label from here
                node = trie
                for byte in word[start : start + longest]:
                    deeper = node.get(byte)
                    if deeper is None:
                        break
                    node = deeper
                token = node[None]
            while token >= 0:
                if not dead[start + size[token]]:
                    if last < 0:
                        break
                    stays = arcs(last << 20 | token)
                    if stays is None:
                        stays = self.arc(last, token)
                    if stays:
                        break
                token = shorter[token]
            if token >= 0:
                tokens.append(token)
                start += size[token]
                last, token = token, -2
            elif tokens:
                # no arc leads on from this prefix's only encoding
                dead[start] = 1
                start -= size[last]
                token = shorter[tokens.pop()]
                last = tokens[-1] if tokens else -1
            else:
                raise ValueError("the vocabulary cannot spell this word")
        return tokens

    @lru_cache(maxsize=100_000)  # noqa: B019
    def _is_own_encoding(self, token: int) -> bool:
        """Whether the merges rebuild a token from its bytes."""
        if token not in self.parts:
            return len(self.label[token]) == 1
        left, right = self.parts[token]
        if not (self._is_own_encoding(left) and self._is_own_encoding(right)):
            return False
        # the border must stay until the token's own merge
        own = self.rank[token]
        for x, x_until in self._edge(left, 1):
            for y, y_until in self._edge(right, 0):
                at = self.merge_rank.get((x, y))
                if (
                    at is not None and at < own and at < x_until and at <= y_until
                    and at > self.rank.get(x, -1) and at > self.rank.get(y, -1)
                ):
                    return False
        return True

    def word(self, word: str) -> str:
        """A word's ids joined by commas."""
        found = self.words.get(word) or self.older_words.get(word)
        if found is None:
            found = ",".join(map(str, self.path(word.encode())))
        if len(word) <= 64:
            if len(self.words) >= WORD_MEMORY // 2:
                self.older_words, self.words = self.words, {}
            self.words[word] = found
        return found

    def spelt_ids(self, text: str) -> str:
        """The ids of a text joined by commas."""
        pieces = self.split_added.split(text) if self.split_added else [text]
        parts = []
        for piece in pieces:
            if piece in self.added:
                parts.append(str(self.added[piece]))
            elif piece:
                known = self.words.get
                parts += [known(w) or self.word(w) for w in split_words(piece)]
        return ",".join(parts)

    def encode(self, text: str) -> list[int]:
        return read_ids(self.spelt_ids(text)).tolist()

    def encode_and_spell(self, text: str) -> tuple[np.ndarray, str]:
        """The ids of a text, and the text decoded from those ids."""
        ids = read_ids(self.spelt_ids(text))
        return ids, self.decode(ids.tolist())

    def decode(self, tokens: Iterable[int]) -> str:
        """The labels of the ids, one after the other."""
        return b"".join(map(self.label.__getitem__, tokens)).decode("utf-8", "replace")


def read_ids(spelt: str) -> np.ndarray:
    """Ids that are joined by commas."""
    return np.fromstring(spelt, np.int32, sep=",")


@lru_cache(maxsize=2)
def automaton(path: str) -> Automaton:
    """One automaton per Python worker and file."""
    return Automaton(path)


def _digests(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(path)
        for batch in batches:
            counts, ids, texts = [], [], []
            for value in batch.column("text"):
                spelt = machine.spelt_ids(value.as_py() or "")
                found = read_ids(spelt).tolist()
                counts.append(len(found))
                ids.append(hashlib.sha256(spelt.encode()).hexdigest())
                texts.append(hashlib.sha256(machine.decode(found).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids, pa.string()),
                 pa.array(texts, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def _tokens(path: str):
    def rows(doc_ids: pa.Array, ids: list[np.ndarray], texts: list[str]) -> pa.RecordBatch:
        ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
        lists = pa.ListArray.from_arrays(ends, np.concatenate(ids))
        return pa.RecordBatch.from_arrays(
            [doc_ids, lists, pa.array(texts, pa.string())], ["doc_id", "ids", "decoded"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(path)
        for batch in batches:
            start, held, ids, texts = 0, 0, [], []
            for row, value in enumerate(batch.column("text"), 1):
                found, spelled = machine.encode_and_spell(value.as_py() or "")
                ids.append(found)
                texts.append(spelled)
                held += len(found)
                if held >= FLUSH or row == batch.num_rows:
                    yield rows(batch.column("doc_id").slice(start, row - start), ids, texts)
                    start, held, ids, texts = row, 0, [], []

    return run


def encode(documents: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and decoded text. ``path`` is a vocabulary file on every executor."""
    kind = dict(documents.dtypes)["doc_id"]
    return map_arrow(
        documents.select("doc_id", "text"), _tokens(path), f"doc_id {kind}, ids array<int>, decoded string"
    )


def digest(documents: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, and the SHA-256 of the ids and of the decoded text."""
    kind = dict(documents.dtypes)["doc_id"]
    return map_arrow(
        documents.select("doc_id", "text"), _digests(path),
        f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    )

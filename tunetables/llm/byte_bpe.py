"""Byte-level BPE: words are encoded along a trie that shares their prefixes, then decoded again.

The last token of a prefix decides the rest of its encoding: the prefix without that token is encoded
as if it stood alone.  So a walk down the trie of all new words of a batch needs one state for each
node, the last token, and every prefix that words share is encoded once.
"""

from __future__ import annotations

import json
import os.path
import re
from collections.abc import Callable
from itertools import chain

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunetables.llm.common import in_pieces, worker_store
from tunetables.llm.encoding import LONGEST, _byte_names

#: How byte-level tokenizers cut a text into words (a fixed value of the format).
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Texts of these characters alone are cut here; all others by the tokenizers library, whose Unicode version rules.
PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-\xac\xae-ɏ–—‘-”…]*")
#: Characters of texts cut together, and words (and strings between spaces) remembered between them.
TOGETHER, REMEMBERED = 1 << 21, 400_000
#: Judged pairs of tokens, and steps of the automaton, that a worker remembers at most.
PAIRS = 1_000_000
NEVER = 1 << 30


def token_pieces(spec: dict) -> list[bytes]:
    """Bytes of each id of a byte-level tokenizer file."""
    byte_of = {name: b for b, name in enumerate(_byte_names())}
    vocab, added = spec["model"]["vocab"], {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    pieces = [b""] * (1 + max([*vocab.values(), *added.values()]))
    for token, i in vocab.items():
        pieces[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
    for token, i in added.items():
        pieces[i] = token.encode()
    return pieces


def decode_ids(pieces: list[bytes], ids: bytes | None) -> str:
    """The text of ids, special tokens included; bytes that are no UTF-8 become U+FFFD."""
    return b"".join(map(pieces.__getitem__, np.frombuffer(ids or b"", "<u4").tolist())).decode("utf-8", "replace")


class Merges:
    """Vocabulary of a byte-level BPE tokenizer file, with the question whether two tokens stay apart."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, cut = spec["model"], spec.get("pre_tokenizer") or {}
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        if model["type"] != "BPE" or cut.get("type") != "ByteLevel" or not cut.get("use_regex", True) or cut.get("add_prefix_space") or spec.get("normalizer") or not plain:
            raise ValueError(f"{os.path.basename(path)} is no plain byte-level BPE")
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec.get("added_tokens", [])):
            raise ValueError("added tokens that take in what stands around them are not supported")
        vocab = model["vocab"]
        #: Bytes of each id.
        self.pieces = token_pieces(spec)
        #: Rank of the merge that makes a token (-1: a byte), and its two parts.
        self.rank = [-1] * len(self.pieces)
        self.parts: list[tuple[int, int]] = [(0, 0)] * len(self.pieces)
        self.merge: dict[tuple[int, int], int] = {}
        whole = [vocab[name] for name in _byte_names()]
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            made = vocab[left + right]
            self.merge.setdefault((vocab[left], vocab[right]), rank)
            if self.rank[made] < 0:
                self.rank[made], self.parts[made] = rank, (vocab[left], vocab[right])
                # a token that its own bytes do not give never ends a prefix
                if self.apart(*self.parts[made], rank):
                    whole.append(made)
        self.sizes = list(map(len, self.pieces))
        self.codes = [i.to_bytes(4, "little") for i in range(len(self.pieces))]
        self._link(whole)

    def _link(self, whole: list[int]) -> None:
        """An automaton over the beginnings of tokens: its state after some bytes is their longest end that begins a token.

        ``found`` lists for each state the tokens that end there, long ones first, as ``(size, token)``.
        """
        self.step: dict[int, int] = {}
        own, depth = {0: -1}, [(0, 0, 0)]
        for i in whole:
            state = 0
            for byte in self.pieces[i]:
                key = state << 8 | byte
                state = self.step.get(key, 0)
                if not state:
                    state = self.step[key] = len(depth)
                    depth.append((depth[key >> 8][0] + 1, key, state))
            own[state] = i
        self.shorter = [0] * len(depth)
        self.found: list[tuple[tuple[int, int], ...]] = [()] * len(depth)
        self.seen: dict[int, int] = {}
        for size, key, state in sorted(depth)[1:]:
            before, byte = key >> 8, key & 255
            self.shorter[state] = self.after(self.shorter[before], byte) if before else 0
            ends = self.found[self.shorter[state]]
            self.found[state] = ((size, own[state]), *ends) if state in own else ends

    def after(self, state: int, byte: int) -> int:
        """The automaton's next state."""
        while state and state << 8 | byte not in self.step:
            state = self.shorter[state]
        return self.step.get(state << 8 | byte, 0)

    def apart(self, a: int, b: int, until: int = NEVER) -> bool:
        """Whether tokens ``a`` and ``b`` side by side are what their bytes give before merge ``until``.

        Merges happen in the order of their ranks, equal ones from the left.  The neighbours at the border
        are followed back in time: the one made last is undone, and no merge across the border may have come first.
        """
        merge, rank, parts = self.merge, self.rank, self.parts
        while True:
            if merge.get((a, b), NEVER) < until:
                return False
            if rank[a] > rank[b]:
                until = rank[a]
                a = parts[a][1]
            elif rank[b] >= 0:
                # the border lies left of this merge, so an equal one across it would have come first
                until = rank[b] + 1
                b = parts[b][0]
            else:
                return True


class TrieEncoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers, and back.

    They are the ids of ``Tokenizer.encode(text, add_special_tokens=False)`` without truncation and padding:
    strings of added tokens in a text become these tokens.  Words, and what stands between single spaces, are
    remembered by the worker up to ``LONGEST`` characters, between one and two times ``REMEMBERED`` of either.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        store = worker_store(f"byte bpe {path}")
        if "merges" not in store:
            store.update(merges=Merges(path), cutter=Tokenizer.from_file(path).pre_tokenizer, pairs={}, words=({}, {}), spaced=({}, {}))
        self.store, self.merges, self.cutter = store, store["merges"], store["cutter"]
        added = sorted(self.merges.added, key=len, reverse=True)
        self.added = regex.compile("(" + "|".join(map(regex.escape, added)) + ")") if added else None

    def _cut(self, text: str) -> list[str]:
        if PLAIN.fullmatch(text):
            return WORDS.findall(text)
        return [text[a:b] for _, (a, b) in self.cutter.pre_tokenize_str(text)]

    def words(self, text: str) -> list[str]:
        """Words and added tokens that the text consists of, in order."""
        if self.added is None or not any(a in text for a in self.merges.added):
            return self._cut(text)
        out = []
        for k, part in enumerate(self.added.split(text)):
            out.extend([part] if k % 2 else self._cut(part))
        return out

    def _single_spaces(self, text: str) -> bool:
        """Whether a plain text may be cut at its spaces, each belonging to what follows."""
        return not (any(pair in text for pair in ("  ", " \t", " \n", " \r")) or text.endswith(" ") or any(a in text for a in self.merges.added)) and bool(PLAIN.fullmatch(text))

    def _known(self, kind: str, wanted: set[str], learn: Callable[[list[str]], dict[str, bytes]]) -> Callable[[str], bytes]:
        """Ids of the wanted strings, remembered or learned now."""
        young, old = self.store[kind]
        new = wanted.difference(young)
        found = {w: old[w] for w in new if w in old}
        found.update(learn([w for w in new if w not in found]))
        brief = {w: i for w, i in found.items() if len(w) <= LONGEST}
        young.update(brief)
        if len(young) > REMEMBERED:
            self.store[kind] = ({}, young)
        return young.__getitem__ if len(brief) == len(found) else lambda w: found.get(w) or young[w]

    def _spaced(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of strings with a space before them."""
        cut = {p: [" " + p] if p.isalpha() else WORDS.findall(" " + p) for p in pieces}
        ids = self._known("words", set(chain.from_iterable(cut.values())), self.learn)
        return {p: b"".join(map(ids, words)) for p, words in cut.items()}

    def learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of each distinct word, by one depth-first walk over the trie of all.

        Sorted words are the trie in depth-first order: what a word shares with the one before is the
        path that stays, and only the nodes below it get a last token.
        """
        merges = self.merges
        out = {w: np.array([merges.added[w]], "<u4").tobytes() for w in words if w in merges.added}
        found, sizes, codes, apart = merges.found, merges.sizes, merges.codes, merges.apart
        seen, pairs = merges.seen, self.store["pairs"]
        for memory in (seen, pairs):
            if len(memory) > PAIRS:
                memory.clear()
        path, last, states = b"", [-1], [0]
        for word, text in sorted((w.encode(), w) for w in words if w not in out):
            shared = 0
            for a, b in zip(path, word):  # noqa: B905  (the shorter one ends it)
                if a != b:
                    break
                shared += 1
            del last[shared + 1 :], states[shared + 1 :]
            state, at = states[-1], shared
            for byte in word[shared:] if shared else word:
                at += 1
                key = state << 8 | byte
                state = seen.get(key, -1)
                if state < 0:
                    state = seen[key] = merges.after(key >> 8, byte)
                # exactly one of the tokens that end here follows the last token before it, or is the whole path
                for size, token in found[state]:
                    if size == at:
                        break
                    pair = last[at - size] << 20 | token
                    fits = pairs.get(pair)
                    if fits is None:
                        fits = pairs[pair] = apart(pair >> 20, token)
                    if fits:
                        break
                last.append(token)
                states.append(state)
            path = word
            ids = []
            while at:
                token = last[at]
                ids.append(codes[token])
                at -= sizes[token]
            ids.reverse()
            out[text] = b"".join(ids)
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text; none for a null or empty one."""
        out = []
        for a, b in in_pieces(texts, TOGETHER):
            spaced = [t.split(" ") if t and self._single_spaces(t) else None for t in texts[a:b]]
            # what no space leads: the beginnings of those texts, and all other texts
            bare = [self._cut(p[0]) if p else self.words(t or "") for p, t in zip(spaced, texts[a:b], strict=True)]
            of_piece = self._known("spaced", set().union(*[p[1:] for p in spaced if p]), self._spaced)
            of_word = self._known("words", set().union(*bare), self.learn)
            for words, pieces in zip(bare, spaced, strict=True):
                out.append(b"".join([*map(of_word, words), *map(of_piece, pieces[1:] if pieces else ())]))
        return out

    def decode(self, ids: bytes | None) -> str:
        return decode_ids(self.merges.pieces, ids)


def encoded(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", back: str | None = None) -> DataFrame:
    """Rows with their ids: little-endian unsigned 32-bit integers in the binary column ``ids``.

    ``path`` names a byte-level BPE tokenizer file that every executor has.  With ``back`` the ids are decoded again
    on the way, into a column of that name.  Null and empty texts have no ids; very long texts and words are
    encoded whole; equal rows stay as they are, an empty table gives an empty table, and other columns,
    null or not, are kept (a column called as ``ids`` or ``back`` says is replaced).
    """

    @F.pandas_udf("ids binary, back string" if back else "ids binary")
    def encode(texts: pd.Series) -> pd.DataFrame:
        encoder = TrieEncoder(path)
        found = encoder.encode([t if isinstance(t, str) else None for t in texts])
        out = {"ids": pd.Series(found, dtype=object)}
        return pd.DataFrame(out | {"back": pd.Series([encoder.decode(i) for i in found], dtype=object)} if back else out)

    # what reads the ids must not encode again
    rows = docs.select(*[docs[f"`{c}`"] for c in docs.columns if c not in (ids, back)], encode.asNondeterministic()(docs[f"`{text}`"]).alias(ids))
    rows = rows.withColumn(back, F.col(f"`{ids}`.back")) if back else rows
    return rows.withColumn(ids, F.col(f"`{ids}`.ids"))


def decoded(rows: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Rows with the text of their ids; null or no ids give the empty text."""

    @F.pandas_udf("string")
    def decode(column: pd.Series) -> pd.Series:
        store = worker_store(f"pieces {path}")
        if "pieces" not in store:
            with open(path, encoding="utf-8") as file:
                store["pieces"] = token_pieces(json.load(file))
        return pd.Series([decode_ids(store["pieces"], i) for i in column], dtype=object)

    return rows.withColumn(text, decode(F.col(f"`{ids}`")))


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens`` and SHA-256 digests of the ids of every text and of what they decode to."""
    return encoded(docs.select("doc_id", "text"), path, back="decoded").select(
        "doc_id",
        F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )

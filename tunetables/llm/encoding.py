"""Encoding with a public tokenizer, word by word with a bounded memory of words."""

from __future__ import annotations

import json
import re
from array import array

import numpy as np

from tunetables.llm.common import worker_store

#: Words longer than this are encoded where they stand and not remembered.
LONGEST = 48
#: A worker remembers between one and two times so many words.
REMEMBERED = 300_000
TOGETHER = 2048
#: Letters whose lower case and normal form are plain, then ASCII punctuation without the apostrophe.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
#: Words on which the short way must agree with the tokenizer, else it isn't taken.
PROBES = ["a", "The", "thing,", "Straße", "ÉAUX!!", "ñandú.", "word|", "ÿ", "Ärger...", "q_", "Zz)*"]


def _byte_names() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Encoder:
    """Ids of whole texts, as bytes of ``dtype``.

    Where the tokenizer drops white space (so that the words between spaces and line ends
    don't see each other), a word is encoded when it is first met and then remembered by the
    worker; words of plain letters and punctuation go straight to the tokenizer's model, all others
    through the whole tokenizer.  For other tokenizers whole texts are encoded.  Either way the
    ids are those of ``Tokenizer.encode(text, add_special_tokens=False)``.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        marks = [t for t in spec.get("added_tokens", []) if t["special"] and not t["normalized"]]
        self.by_word = steps[0].get("type") == "Split" and steps[0].get("behavior") == "Removed" and bool(steps[0].get("invert")) and bool(marks)
        self.mark, self.mark_id = (marks[-1]["content"], marks[-1]["id"]) if marks else ("", -1)
        self.specials = [t["content"] for t in marks]
        self.names = _byte_names()
        self.ends: dict[str, bytes] = {"": b""}
        kept = worker_store(f"ids {path}")
        self.kept = kept
        kept.setdefault("young", {})
        kept.setdefault("old", {})
        self.short = self.by_word and all(self._plain(*PLAIN.fullmatch(w).groups()) == self._whole(w) for w in PROBES)

    def _whole(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _plain(self, letters: str, end: str) -> bytes:
        if end not in self.ends:
            if len(self.ends) > 10_000:
                self.ends = {"": b""}
            self.ends[end] = self._whole(end)
        letters = letters.lower()
        if not letters.isascii():
            letters = "".join(map(self.names.__getitem__, letters.encode()))
        return array(self.code, [t.id for t in self.tokenizer.model.tokenize(letters)]).tobytes() + self.ends[end]

    def _learn(self, words: list[str], into: dict[str, bytes]) -> None:
        rest = []
        for word in words:
            found = PLAIN.fullmatch(word) if self.short else None
            if found:
                into[word] = self._plain(*found.groups())
            elif "<" in word and any(s in word for s in self.specials):
                into[word] = self._whole(word)
            else:
                rest.append(word)
        for at in range(0, len(rest), TOGETHER):
            part = rest[at : at + TOGETHER]
            [encoded] = self.tokenizer.encode_batch_fast([self.mark.join(part)], add_special_tokens=False)
            ids = np.array(encoded.ids, np.int64)
            ends = np.flatnonzero(ids == self.mark_id)
            whole = ids.astype(self.dtype)
            cuts = [0, *(ends + 1).tolist(), len(ids) + 1]
            for word, a, b in zip(part, cuts[:-1], cuts[1:], strict=True):
                into[word] = whole[a : b - 1].tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text; none for a null or empty one."""
        if not self.by_word:
            found = self.tokenizer.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)
            return [array(self.code, e.ids).tobytes() for e in found]
        out, kept = [], self.kept
        for text in texts:
            words = (text or "").replace("\n", " ").split(" ")
            young, old = kept["young"], kept["old"]
            new = set(words).difference(young)
            if new:
                own, unseen = {}, []
                for word in new:
                    ids = old.get(word)
                    if ids is None:
                        unseen.append(word)
                    else:
                        own[word] = ids
                self._learn(unseen, own)
                brief = {w: ids for w, ids in own.items() if len(w) <= LONGEST}
                young.update(brief)
                if len(brief) < len(own):
                    out.append(b"".join([own[w] if w in own else young[w] for w in words]))
                else:
                    out.append(b"".join(map(young.__getitem__, words)))
                if len(young) > REMEMBERED:
                    kept["old"], kept["young"] = young, {}
            else:
                out.append(b"".join(map(young.__getitem__, words)))
        return out

"""SentencePiece encoding and decoding for byte-pair models, exact by backtracking.

A text is cut where no merge can cross: before a word mark that follows another character, around
characters without a piece, between letters and other characters if no piece holds both, and between
a run of word marks and its last one. Within a segment the
tokens are found from left to right: the longest piece that starts here (all pieces of the segment
come from one Aho-Corasick pass), if merging it afresh with the token before leaves the two as they
are; else the next shorter piece; if none is left, the token before is taken back and its end marked
in a bitfield of failed positions, which is never tried again. A sequence whose neighbours are all
compatible is the one that merging would give, so the result equals the library's at linear cost.

Model: a serialized SentencePiece byte-pair model whose normalizer is the identity with a leading
word mark. Others are refused.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable
from itertools import groupby

import ahocorasick

MARK = "▁"
#: Segments kept in memory at most with their ids, and the longest of these.
CACHED, CACHED_CHARS = 250_000, 48


class PieceCodec:
    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as proto

        spec = proto.ModelProto.FromString(model)
        norm = spec.normalizer_spec
        if spec.trainer_spec.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or not norm.escape_whitespaces or spec.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only byte-pair models with the identity normalizer and a leading word mark")
        self.eos = spec.trainer_spec.eos_id
        self.unknown = spec.trainer_spec.unk_id
        kind = proto.ModelProto.SentencePiece
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.byte_id: dict[int, int] = {}
        self.shown: list[str] = []
        for i, p in enumerate(spec.pieces):
            if p.type == kind.NORMAL:
                self.id[p.piece], self.score[p.piece] = i, p.score
                self.shown.append(p.piece.replace(MARK, " "))
            elif p.type == kind.BYTE:
                value = int(p.piece[1:-1], 16)
                self.byte_id[value] = i
                # Bytes above ASCII travel as lone surrogates until whole characters are there.
                self.shown.append(chr(value) if value < 128 else chr(0xDC00 + value))
            elif p.type == kind.USER_DEFINED:
                raise ValueError("models with user-defined pieces are not supported")
            else:
                self.shown.append(spec.trainer_spec.unk_surface if p.type == kind.UNKNOWN else "")
        if any(MARK in p.lstrip(MARK) for p in self.id):
            raise ValueError("pieces across word marks are not supported")
        if len(self.byte_id) not in (0, 256):
            raise ValueError("all bytes or none must have pieces")
        if any(p.startswith(MARK * 2) and p.strip(MARK) for p in self.id):
            raise ValueError("pieces of several word marks and a word are not supported")
        self.name = {i: p for p, i in self.id.items()}
        self.starts_with_mark = {i for p, i in self.id.items() if p.startswith(MARK)}
        self.length = {i: len(p) for p, i in self.id.items()}
        self.automaton = ahocorasick.Automaton()
        for p, i in self.id.items():
            if len(p) == 1 or self.merged(p) == [p]:  # a piece that merging can't reach is never a token
                self.automaton.add_word(p, (len(p) - 1, i))
        self.automaton.make_automaton()
        tokens = {p: self.id[p] for p in self.automaton.keys()}
        #: The longest token that is a proper prefix of a token; -1 if there is none.
        self.shorter = {i: next((tokens[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in tokens), -1) for p, i in tokens.items()}
        self.compatible: dict[int, bool] = {}
        self.segments: dict[str, tuple[int, ...]] = {}
        single = {p for p in self.id if len(p) == 1}
        letters = "".join(re.escape(c) for c in sorted(single - {MARK}) if c.isalpha())
        others = "".join(re.escape(c) for c in sorted(single - {MARK}) if not c.isalpha())
        mixed = re.compile(f"[{letters}][{others}]|[{others}][{letters}]")
        if any(mixed.search(p) for p in self.id):
            letters, others = letters + others, ""
        same = f"[{letters}]+|[{others}]+" if others else f"[{letters}]+"
        self.cut = re.compile(f"{MARK}+(?:{same})?|{same}|(?s:.)")

    def merged(self, symbols: Iterable[str]) -> list[str]:
        """Plain merging: time and again the best-scored neighbours, the leftmost of equals."""
        part: list[str | None] = list(symbols)
        after = list(range(1, len(part) + 1))
        before = list(range(-1, len(part) - 1))
        heap: list[tuple[float, int, int, str]] = []

        def offer(i: int, j: int) -> None:
            both = part[i] + part[j]
            if both in self.score:
                heapq.heappush(heap, (-self.score[both], i, j, both))

        for i in range(len(part) - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, both = heapq.heappop(heap)
            if part[i] is None or part[j] is None or after[i] != j or part[i] + part[j] != both:
                continue
            part[i], part[j], after[i] = both, None, after[j]
            if after[i] < len(part):
                before[after[i]] = i
                offer(i, after[i])
            if before[i] >= 0:
                offer(before[i], i)
        return [p for p in part if p is not None]

    def fits(self, a: int, b: int) -> bool:
        """Whether merging the characters of two neighbouring tokens gives these two tokens."""
        key = a * len(self.shown) + b
        known = self.compatible.get(key)
        if known is None:
            known = self.compatible[key] = self.merged(self.name[a] + self.name[b]) == [self.name[a], self.name[b]]
        return known

    def backtrack(self, text: str) -> list[int]:
        """Ids of a segment of characters that all have pieces, with one word mark at most, at its start."""
        longest = {end - back: i for end, (back, i) in self.automaton.iter(text)}
        good, tokens, at, total = (1 << len(text) + 1) - 1, [], 0, len(text)
        length, known, base = self.length, self.compatible, len(self.shown)
        token, before = longest[0], -1
        while True:
            end = at + length[token]
            if good >> end & 1:
                fit = before < 0 or known.get(before * base + token)
                if fit is None:
                    fit = self.fits(before, token)
                if fit:
                    tokens.append(token)
                    if end == total:
                        return tokens
                    at, before, token = end, token, longest[end]
                    continue
            token = self.shorter[token]
            while token < 0:  # nothing fits here: the token before was wrong
                good &= ~(1 << at)
                token = tokens.pop()
                before = tokens[-1] if tokens else -1
                at -= length[token]
                token = self.shorter[token]

    def segment(self, text: str) -> tuple[int, ...]:
        if text[0] != MARK:
            if text[0] in self.id:
                return tuple(self.backtrack(text)) if len(text) <= 4096 else tuple(self.long(text))
            return tuple(self.byte_id[b] for b in text.encode()) if self.byte_id else (self.unknown,)
        word = text.lstrip(MARK)
        run = len(text) - len(word)
        if not word:
            return self.run(run)
        tokens = (self.backtrack if len(word) < 4096 else self.long)(MARK + word)
        if tokens[0] == self.id[MARK]:  # the last mark merged with nothing of the word
            return (*self.run(run), *tokens[1:])
        return (*self.run(run - 1), *tokens)

    def long(self, text: str) -> list[int]:
        """As ``backtrack``, with the bitfield as an array: whole numbers of many bits would cost their length each time."""
        longest = {end - back: i for end, (back, i) in self.automaton.iter(text)}
        good, tokens, at = bytearray(b"\1") * (len(text) + 1), [], 0
        token = longest[0]
        while at < len(text):
            end = at + self.length[token]
            if good[end] and (not tokens or self.fits(tokens[-1], token)):
                tokens.append(token)
                at, token = end, longest.get(end, -1)
                continue
            token = self.shorter[token]
            while token < 0:
                good[at] = 0
                token = tokens.pop()
                at -= self.length[token]
                token = self.shorter[token]
        return tokens

    def run(self, n: int) -> tuple[int, ...]:
        """A run of word marks: its pieces have one score, and merge after all others, from the left."""
        return tuple(self.id[p] for p in self.merged(MARK * n)) if n else ()

    def encode(self, text: str | None) -> list[int]:
        """Ids without an end id. Null and empty texts have none.

        Texts are read whole, whatever their length; equal texts have equal ids; of equally good merges the leftmost comes first, as in the library.
        """
        if not text:
            return []
        known, out = self.segments, []
        for part in self.cut.findall(MARK + text.replace(" ", MARK)):
            ids = known.get(part)
            if ids is None:
                ids = self.segment(part)
                if len(part) <= CACHED_CHARS:
                    if len(known) >= CACHED:
                        known.clear()
                    known[part] = ids
            out += ids
        if len(self.compatible) > 4 * CACHED:
            self.compatible.clear()
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """The text of the ids; the leading word mark's blank is dropped, broken characters become U+FFFD byte by byte.

        Bytes on either side of an id without a text make no character together.
        """
        ids = list(ids)
        shown = list(map(self.shown.__getitem__, ids))
        text = "".join(shown)
        lead = next((i for i, part in zip(ids, shown) if part), None)
        if lead in self.starts_with_mark:
            text = text[1:]
        if text.isascii():
            return text
        if "" in shown[:-1]:
            if lead in self.starts_with_mark:
                shown[ids.index(lead)] = shown[ids.index(lead)][1:]
            runs = groupby(zip(ids, shown), key=lambda pair: bool(self.shown[pair[0]]))
            return "".join(self._characters("".join(part for _, part in run)) for _, run in runs)
        return self._characters(text)

    @staticmethod
    def _characters(text: str) -> str:
        raw = text.encode("utf-8", "surrogateescape")
        try:
            return raw.decode("utf-8")
        except UnicodeDecodeError:
            return raw.decode("utf-8", "broken-bytes")


def _one_by_one(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


import codecs  # noqa: E402

codecs.register_error("broken-bytes", _one_by_one)

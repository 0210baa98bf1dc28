"""Token ids of whole texts from a public tokenizer file, cached by stretch of text.

A text is cut where white space begins, which no token of these tokenizers crosses; texts
of Latin-1 without apostrophes also where letters begin or end, which none crosses there
(apostrophes may join the letters that follow). Each new stretch is encoded by the library; a cache of bounded size holds the ids as
bytes. Texts with white space beyond ASCII, where the cut could differ from the
tokenizer's own rules, go through the library whole.

With `specials`, as the registered queries and the pipeline have it, the literal of an added
token such as <|endoftext|> is that token, by the library's default; texts that contain one
go through the library whole. Without, literals are text like any other."""

from __future__ import annotations

import os
import re
import sys
import types

import numpy as np

#: White space, or what engines may count as such, beyond the six ASCII characters.
_ODD_POINTS = [0x1C, 0x1D, 0x1E, 0x1F, 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200E), 0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF]
_ODD = re.compile("[" + "".join(map(chr, _ODD_POINTS)) + "]")
_ODD_ASCII = [chr(c) for c in _ODD_POINTS if c < 128]
#: Letters of Latin-1, as \\p{L} has them.
_L = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
_BEYOND = re.compile("['\u0100-\U0010ffff]")
_FINE = re.compile(rf"[ \t-\r]*(?:[{_L}]+|[^{_L} \t-\r]+)|[ \t-\r]+$")
_FINE_WORDS = re.compile(rf"[{_L}]+|[^{_L} \t-\r]+")
_STRETCH = re.compile(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+$")
#: Entries of the cache, and the longest stretch it keeps.
CACHE, CACHED_CHARS = 1_000_000, 32
#: Stretches joined for one call, and characters of texts that are cut at once.
JOINED, GROUP_CHARS = 500, 1_000_000
_SPACES = " \t\n\r\x0b\x0c"


class Encoder:
    """ids(texts) -> the ids of each text, as little-endian unsigned 32-bit integers.

    drops_space says that the tokenizer drops white space and case, so that stretches are words;
    specials, that literals of added tokens are these tokens.
    New stretches of many texts are joined to one text for the library, since a call for
    each would cost more than the encoding. Whose the tokens are is told by the bytes that
    each token stands for, or, where normalisation can change lengths, by offsets."""

    def __init__(self, path: str, drops_space: bool = False, cache: int = CACHE, specials: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not specials
        # in any case, as some are looked for in normalised text; the library decides
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content] if specials else []
        self.added = re.compile("|".join(map(re.escape, added)), re.IGNORECASE) if added else None
        self.heads = {h for t in added for h in (t[0].lower(), t[0].upper())}
        # two generations: when the new one is full, the old one goes, and with it what was not used since
        self.drops_space, self.most, self.cache, self.old = drops_space, cache, {}, {}
        # bytes of each token: its characters stand for one byte each, but for the mark of a word's end
        mark = "</w>" if drops_space else ""
        self.bytes_of = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.bytes_of[i] = len(token.removesuffix(mark) if mark else token)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _joined(self, parts: list[str]) -> list[bytes]:
        """The ids of each part; between two parts white space begins."""
        found = self.tokenizer.encode_batch_fast([(" " if self.drops_space else "").join(parts)], add_special_tokens=False)[0]
        ids = np.array(found.ids, "<u4")
        upto = np.concatenate([[0], np.cumsum(self.bytes_of[ids])])
        ends = np.cumsum([len(p.encode()) for p in parts])
        cuts = np.searchsorted(upto, ends)
        if cuts[-1] != len(ids) or (upto[cuts] != ends).any():
            return self._by_offsets(parts)
        cuts, raw = [0, *(4 * cuts).tolist()], ids.tobytes()
        return [raw[i:j] for i, j in zip(cuts[:-1], cuts[1:], strict=True)]

    def _by_offsets(self, parts: list[str]) -> list[bytes]:
        gap = 1 if self.drops_space else 0
        found = self.tokenizer.encode((" " * gap).join(parts), add_special_tokens=False)
        starts = np.cumsum([0, *[len(p) + gap for p in parts]])
        at = np.array([o[0] for o in found.offsets], np.int64)
        cuts = 4 * np.searchsorted(at, starts)
        raw = np.array(found.ids, "<u4").tobytes()
        return [raw[i:j] for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]

    def _new(self, parts: list[str]) -> dict[str, bytes]:
        if self.drops_space:
            alone, odd = [], [p for p in parts if _BEYOND.search(p) or p != p.lower()]
        else:
            alone, odd = [p for p in parts if p[0] not in _SPACES or p[-1] in _SPACES], []
        fresh = {p: self._whole(p) for p in alone}
        apart = {*alone, *odd}
        for some, told in ((odd, self._by_offsets), ([p for p in parts if p not in apart], self._joined)):
            for k in range(0, len(some), JOINED):
                part = some[k : k + JOINED]
                fresh.update(zip(part, told(part), strict=True))
        return fresh

    def _cut(self, text: str | None) -> list[str] | None:
        """The stretches of a text; None if the library must take it whole."""
        if text is None or (any(c in text for c in _ODD_ASCII) if (ascii_ := text.isascii()) else _ODD.search(text)):
            return None
        if self.added and any(h in text for h in self.heads) and self.added.search(text):
            return None
        if "'" in text if ascii_ else _BEYOND.search(text):
            return text.split() if self.drops_space else _STRETCH.findall(text)
        # lower case of Latin-1 is the tokenizer's own, and needs no context
        return _FINE_WORDS.findall(text.lower()) if self.drops_space else _FINE.findall(text)

    def ids(self, texts: list[str | None]) -> list[bytes]:
        cut = [self._cut(t) for t in texts]
        get = self.cache.get
        found = [None if c is None else list(map(get, c)) for c in cut]
        # places of the stretches that the cache lacks
        lacks, new = [], {}
        for c, f in zip(cut, found, strict=True):
            at = []
            if f and None in f:
                k = -1
                for _ in range(f.count(None)):
                    k = f.index(None, k + 1)
                    at.append(k)
                    new[c[k]] = None
            lacks.append(at)
        fresh = {p: self.old[p] for p in new if p in self.old}
        fresh |= self._new([p for p in new if p not in fresh])
        out = []
        for t, c, f, at in zip(texts, cut, found, lacks, strict=True):
            if f is None:
                out.append(self._whole(t) if t else b"")
                continue
            for k in at:
                f[k] = fresh[c[k]]
            out.append(b"".join(f))
        if len(self.cache) + len(fresh) > self.most // 2:
            self.old, self.cache = self.cache, {}
        self.cache.update((p, f) for p, f in fresh.items() if len(p) <= CACHED_CHARS)
        return out

    def stream(self, texts):
        """ids() of an iterable of texts, in groups of bounded size."""
        held, size = [], 0
        for t in texts:
            held.append(t)
            size += len(t or "") + 64
            if size > GROUP_CHARS:
                yield from self.ids(held)
                held, size = [], 0
        yield from self.ids(held)


def encoder(path: str, drops_space: bool = False, specials: bool = False) -> Encoder:
    """One encoder a worker process and file, which later tasks of the process find warm.

    It hangs on a module of its own: globals here travel with each task and start empty."""
    held = sys.modules.setdefault("pseudora_worker_encoders", types.ModuleType("pseudora_worker_encoders")).__dict__
    if (path, drops_space, specials) not in held:
        held[path, drops_space, specials] = Encoder(path, drops_space, specials=specials)
    return held[path, drops_space, specials]


def public(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)

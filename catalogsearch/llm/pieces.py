"""Exact and fast tokenization: a text is cut where no token can span the cut, and each distinct piece is encoded once.

The pre-tokenizers used here never join a character that is not white space with white space after it. A text can
therefore be cut there, and equal pieces have equal ids wherever they stand. Arrow cuts the texts of a batch and numbers
the distinct pieces; a worker keeps the ids of the pieces it has met, up to a number of pieces, and the ids of whole texts
are gathered from them. The cache changes the time alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .shared import kept_by_worker

#: The characters of Unicode's White_Space property.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Letters of one code point each, which no pre-tokenizer parts.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
PIECE = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
CUT = re.compile(f"(?<=[^{WHITE}])[{WHITE}]")
#: White space before a space: a cut at every space would part the run.
RUNS = [chr(c) + " " for c in range(0x3001) if re.match(f"[{WHITE}]", chr(c))]
ASCII_RUNS = [r for r in RUNS if r.isascii()]
OTHER_RUNS = [r for r in RUNS if not r.isascii()]
ONE_SPACE = re.compile(f" [^ ]*[^{WHITE}]")
PLAIN_WORD = re.compile(f"[{LETTERS}]+[.,]?")

#: Pieces in a worker's cache, pieces encoded at a time, and characters that are cut at a time.
CACHE_PIECES = 800_000
MISSES = 2048
BLOCK_CHARS = 1 << 23


def parts_runs(text: str) -> bool:
    """Whether a cut at every space parts a run of white space, or leaves one at the end."""
    return text.endswith(" ") or any(r in text for r in ASCII_RUNS) or (not text.isascii() and any(r in text for r in OTHER_RUNS))


def blocks(text: str, size: int = BLOCK_CHARS) -> Iterator[str]:
    """The text in parts of about that size, each cut before white space."""
    start = 0
    while len(text) - start > size:
        found = CUT.search(text, start + size)
        if found is None:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:] if start else text


class PieceEncoder:
    """Ids of whole texts, as little-endian unsigned 32-bit bytes. Subclasses encode single pieces.

    `spaces` tells whether white space belongs to the piece after it or is dropped.
    """

    spaces = True

    def __init__(self, cache_pieces: int = CACHE_PIECES):
        self.limit = cache_pieces
        self.cache: dict[str, bytes] = {}

    def learn(self, pieces: list[str]) -> dict[str, bytes]:
        """The ids of each piece."""
        raise NotImplementedError

    def _known(self, pieces: list[str]) -> list[bytes]:
        find = self.cache.get
        out = [find(p) for p in pieces]
        missing = [i for i, x in enumerate(out) if x is None]
        if missing:
            learned = self.learn([pieces[i] for i in missing])
            for i in missing:
                out[i] = learned[pieces[i]]
            if len(self.cache) + len(learned) <= self.limit:
                self.cache.update(learned)
        return out

    def _gather(self, flat: pa.Array, bounds: np.ndarray, prefix: str = "") -> list[bytes]:
        """The ids of runs of pieces."""
        numbered = flat.dictionary_encode()
        names = numbered.dictionary.to_pylist()
        known = pa.array(self._known([prefix + n for n in names] if prefix else names), pa.binary())
        joined = known.take(numbered.indices)
        if len(joined) == 0:
            return [b""] * (len(bounds) - 1)
        ends = np.frombuffer(joined.buffers()[1], np.int32)[: len(joined) + 1][bounds].tolist()
        data = memoryview(joined.buffers()[2] or b"")
        return [bytes(data[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def _careful(self, texts: list[str]) -> list[bytes]:
        lists = [PIECE.findall(t) for t in texts]
        bounds = np.cumsum([0, *map(len, lists)])
        return self._gather(pa.array([p for x in lists for p in x], pa.string()), bounds)

    def _together(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        if not self.spaces:
            parts = pc.ascii_split_whitespace(pa.array(texts, pa.string()))
            return self._gather(parts.flatten(), parts.offsets.to_numpy())
        odd = [i for i, t in enumerate(texts) if parts_runs(t)]
        if odd:
            out: list[bytes] = [b""] * len(texts)
            for i, ids in zip(odd, self._careful([texts[i] for i in odd]), strict=True):
                out[i] = ids
            sound = sorted(set(range(len(texts))).difference(odd))
            for i, ids in zip(sound, self._together([texts[i] for i in sound]), strict=True):
                out[i] = ids
            return out
        parts = pc.split_pattern(pa.array(texts, pa.string()), " ")
        offsets = parts.offsets.to_numpy()
        flat = parts.flatten()
        firsts = self._known(flat.take(pa.array(offsets[:-1])).to_pylist())
        rest = np.ones(len(flat), bool)
        rest[offsets[:-1]] = False
        after = self._gather(flat.filter(pa.array(rest)), offsets - np.arange(len(offsets)), " ")
        return [a + b for a, b in zip(firsts, after, strict=True)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        out: list[bytes] = []
        group: list[str] = []
        size = 0
        for text in texts:
            if len(text) > BLOCK_CHARS:
                out += self._together(group)
                group, size = [], 0
                out.append(b"".join(self._together([b])[0] for b in blocks(text)))
                continue
            group.append(text)
            size += len(text)
            if size > BLOCK_CHARS:
                out += self._together(group)
                group, size = [], 0
        return out + self._together(group)


class TokenizerPieces(PieceEncoder):
    """Equal to `Tokenizer.encode(text, add_special_tokens=False)` of the whole text.

    That call takes the string of a special token in a text for the token, before anything else is looked at. So such a text
    is cut there, and what stands between is encoded by itself.
    """

    def __init__(self, path: str, spaces: bool, cache_pieces: int = CACHE_PIECES):
        from tokenizers import Tokenizer

        super().__init__(cache_pieces)
        self.spaces = spaces
        self.plain = Tokenizer.from_file(path)
        special = {t.content: i for i, t in self.plain.get_added_tokens_decoder().items()}
        self.special = {text: np.array([i], "<u4").tobytes() for text, i in special.items()}
        self.at_special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        vocabulary = self.plain.get_vocab()
        self.bound = np.zeros(max(vocabulary.values()) + 1, bool)
        space = "Ġ"  # how a byte-level vocabulary writes a space
        for token, i in vocabulary.items():
            self.bound[i] = token.startswith(space) if spaces else token.endswith("</w>")
        self.simple = ONE_SPACE if spaces else PLAIN_WORD

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.plain.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def encode(self, texts: list[str]) -> list[bytes]:
        odd = [i for i, t in enumerate(texts) if any(s in t for s in self.special)]
        if not odd:
            return super().encode(texts)
        parts = [self.at_special.split(texts[i]) for i in odd]
        between = [p for part in parts for p in part[::2]]
        chosen = set(odd)
        ids = iter(super().encode(between + [t for i, t in enumerate(texts) if i not in chosen]))
        joined = {i: b"".join(self.special[p] if k % 2 else next(ids) for k, p in enumerate(part)) for i, part in zip(odd, parts, strict=True)}
        return [joined[i] if i in chosen else next(ids) for i in range(len(texts))]

    def learn(self, pieces: list[str]) -> dict[str, bytes]:
        """Plain pieces are encoded in one text, whose ids show where each begins (a space) or ends (an end of word)."""
        learned, plain = {}, []
        for piece in pieces:
            if self.simple.fullmatch(piece):
                plain.append(piece)
            else:
                learned[piece] = self._ids(piece).tobytes()
        for start in range(0, len(plain), MISSES):
            part = plain[start : start + MISSES]
            ids = self._ids(("" if self.spaces else " ").join(part))
            marks = np.flatnonzero(self.bound[ids])
            if self.spaces:
                bounds = np.append(marks, len(ids))
            else:
                words = np.cumsum([2 if p[-1] in ".," else 1 for p in part])
                bounds = np.concatenate(([0], marks[words - 1] + 1))
            data, bounds = ids.tobytes(), (bounds * 4).tolist()
            learned |= {p: data[a:b] for p, a, b in zip(part, bounds[:-1], bounds[1:], strict=True)}
        return learned


def encoder(path: str, spaces: bool) -> TokenizerPieces:
    """One encoder a worker, kept between its tasks."""
    return kept_by_worker(("pieces", path, spaces), lambda: TokenizerPieces(path, spaces))

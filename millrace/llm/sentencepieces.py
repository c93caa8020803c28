"""SentencePiece encoding of the merge type (BPE) without its priority queue.

A sequence of pieces is the encoding of a text exactly if each two neighbours stay as they are when their joined
text is merged anew. So the encoder walks over the text with the longest match of an Aho-Corasick automaton, checks
each new neighbour by re-merging (remembered for each pair), tries shorter matches where that fails, and steps back
where none is left; positions from which no way was found are marked and never tried twice.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import WordMemory, Words, bounded_batches, byte_table, lean, slices, texts_of

SPACE_MARK = "▁"
_MARK_BYTES = SPACE_MARK.encode()
_UNITS = re.compile(f"{SPACE_MARK}+[^{SPACE_MARK}]*")
#: Units and pairs remembered by a worker; when full, the memory is emptied. It changes speed, never results.
MOST_UNITS = 150_000
MOST_PAIRS = 200_000
LONGEST_KEPT = 48
#: Different words whose ids a worker remembers, unless an operator's caller asks for less memory.
REMEMBERED = 1_000_000


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class PieceEncoder:
    def __init__(self, model: str | None = None):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model or default_model())
        lib, n = self.library, self.library.vocab_size()
        normal = [i for i in range(n) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i))]
        self.ids = {lib.id_to_piece(i): i for i in normal}
        self.scores = {p: lib.get_score(i) for p, i in self.ids.items()}
        self.bytes_ids = {}
        for b in range(256):
            i = lib.piece_to_id(f"<0x{b:02X}>")
            if lib.is_byte(i):
                self.bytes_ids[b] = i
        self.unknown = lib.unk_id()
        self.matcher = ahocorasick.Automaton()
        for p in self.ids:
            if len(p) > 1:  # a single sign is always a possible match, the last
                self.matcher.add_word(p, len(p))
        if len(self.matcher):
            self.matcher.make_automaton()
        #: Signs that stand together in some piece; between others nothing ever merges.
        self.joined = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        held: dict[float, list[str]] = {}
        for p, s in self.scores.items():
            if len(p) > 1:
                held.setdefault(s, []).append(p)
        #: Pieces of equal score: their order depends on place, so units with one are merged as a whole.
        self.tied = [p for ps in held.values() if len(ps) > 1 for p in ps]
        self.tie_at = min((len(p) for p in self.tied), default=0)
        self.tie_search = re.compile("|".join(map(re.escape, sorted(self.tied, key=len)))) if self.tied else None
        # neighbours never merge across the start of a run of space marks if no piece has a mark after another sign
        self.separable = not any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in self.ids)
        self.pairs: dict[tuple[str, str], bool] = {}
        self.grown: dict[str, tuple | None] = {}
        self.units: dict[str, tuple[bytes, str, int]] = {}

    def merge(self, text: str) -> list[str]:
        """The encoding by its definition: always the pair of the best score, the leftmost of equals."""
        part = list(text)
        n = len(part)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap: list[tuple[float, int, int, str]] = []

        def offer(i: int) -> None:
            j = right[i]
            if j < n and (s := self.scores.get(joined := part[i] + part[j])) is not None:
                heapq.heappush(heap, (-s, i, j, joined))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, j, joined = heapq.heappop(heap)
            if not part[i] or not part[j] or right[i] != j or part[i] + part[j] != joined:
                continue
            part[i], part[j] = joined, ""
            right[i] = right[j]
            if right[j] < n:
                left[right[j]] = i
            if left[i] >= 0:
                offer(left[i])
            offer(i)
        return [p for p in part if p]

    def edges(self, piece: str) -> tuple[list[tuple[str, float]], list[tuple[str, float]]] | None:
        """What stands at the left and at the right edge of a piece while it is merged from single signs, each with
        the score of the merge that ends it (-inf for the piece itself). None where merges don't come in the order of
        their scores, so that scores don't tell when something stands there."""
        if piece in self.grown:
            return self.grown[piece]
        part, left, right, last = list(piece), [], [], math.inf
        good = len(piece) == 1 or piece in self.scores
        while len(part) > 1 and good:
            offers = [(self.scores.get(x + y, -math.inf), -i) for i, (x, y) in enumerate(zip(part, part[1:], strict=False))]
            score, i = max(offers)
            i = -i
            good = -math.inf < score <= last
            last = score
            if i == 0:
                left.append((part[0], score))
            if i == len(part) - 2:
                right.append((part[-1], score))
            part[i : i + 2] = ["".join(part[i : i + 2])]
        out = ([*left, (piece, -math.inf)], [*right, (piece, -math.inf)]) if good else None
        if piece in self.scores or len(piece) == 1:
            self.grown[piece] = out
        return out

    def fits(self, before: str, after: str) -> bool:
        """Whether the two stay neighbours when their text is merged; '' before the first."""
        known = self.pairs.get((before, after))
        if known is None:
            if len(self.pairs) >= MOST_PAIRS:
                self.pairs.clear()
            known = self.pairs[before, after] = self.merged_apart(before, after)
        return known

    def merged_apart(self, before: str, after: str) -> bool:
        mine, other = self.edges(before) if before else None, self.edges(after)
        if not before:
            return other is not None or self.merge(after) == [after]
        if mine is None or other is None:
            return self.merge(before + after) == [before, after]
        # merge both sides step by step, the better score first, and see whether the seam would come before either
        ours, theirs, i, j = mine[1], other[0], 0, 0
        while True:
            (x, next_x), (y, next_y) = ours[i], theirs[j]
            seam = self.scores.get(x + y)
            if seam is not None and seam > next_x and seam >= next_y:
                return False
            if next_x == next_y == -math.inf:
                return True
            if next_x >= next_y:
                i += 1
            else:
                j += 1

    def pieces(self, unit: str) -> list[str]:
        """Pieces of a text in which pieces have scores of their own."""
        n = len(unit)
        if n == 1 or not len(self.matcher):
            return list(unit)
        if self.tie_search and n >= self.tie_at and self.tie_search.search(unit):
            return self.merge(unit)
        found: list[list[int]] = [[1] for _ in range(n)]
        for end, length in self.matcher.iter(unit):  # ends come in order, so the longest is the last
            found[end - length + 1].append(length)
        pairs, fits = self.pairs.get, self.fits
        dead = bytearray(n + 1)
        chosen: list[str] = []
        before, at, tries = "", 0, []
        lengths = found[0]
        k = len(lengths)
        while True:
            while k:
                k -= 1
                end = at + lengths[k]
                if not dead[end]:
                    piece = unit[at:end]
                    good = pairs((before, piece))
                    if good or good is None and fits(before, piece):
                        break
            else:  # no way from here: step back
                if not chosen:
                    return self.merge(unit)  # only if a piece can't be made by merging
                dead[at] = 1
                at -= len(chosen.pop())
                before = chosen[-1] if chosen else ""
                lengths, k = found[at], tries.pop()
                continue
            chosen.append(piece)
            if end == n:
                return chosen
            tries.append(k)
            before, at = piece, end
            lengths = found[at]
            k = len(lengths)

    def made(self, piece: str) -> tuple[bytes, str, int]:
        if (i := self.ids.get(piece)) is not None:
            ids = [i]
        else:
            ids = [self.bytes_ids[b] for b in piece.encode()] if self.bytes_ids else [self.unknown]
        return array("i", ids).tobytes(), "".join([f"{i}," for i in ids]), len(ids)

    def kept(self, text: str, make) -> tuple[bytes, str, int]:
        out = make(text)
        if len(text) <= LONGEST_KEPT:
            if len(self.units) >= MOST_UNITS:
                self.units.clear()
            self.units[text] = out
        return out

    def part(self, text: str) -> tuple[bytes, str, int]:
        """Of a text inside which merging is possible everywhere."""
        return self.together(self.pieces(text), self.made)

    def unit(self, text: str) -> tuple[bytes, str, int]:
        """Ids of a unit as bytes of int32 and as decimal text with a comma after each, and their number."""
        joined = self.joined
        cuts = [i for i in range(1, len(text)) if text[i - 1 : i + 1] not in joined]
        if not cuts:
            return self.part(text)
        return self.together([text[i:j] for i, j in zip([0, *cuts], [*cuts, len(text)], strict=True)], self.part)

    def together(self, texts: list[str], make) -> tuple[bytes, str, int]:
        units = self.units
        parts = [units.get(t) or self.kept(t, make) for t in texts]
        return b"".join([p[0] for p in parts]), "".join([p[1] for p in parts]), sum([p[2] for p in parts])

    def split(self, text: str) -> list[str]:
        if not text:
            return []
        marked = SPACE_MARK + text.replace(" ", SPACE_MARK)
        return _UNITS.findall(marked) if self.separable else [marked]

    def encode(self, text: str) -> tuple[bytes, str, int]:
        """As ``unit``, for a whole text."""
        return self.together(self.split(text), self.unit)

    def ids_of(self, text: str) -> list[int]:
        return np.frombuffer(self.encode(text)[0], dtype=np.int32).tolist()


@lru_cache(maxsize=2)
def encoder_of(model: str | None) -> PieceEncoder:
    """One for each worker process, so that what it remembers outlives a task."""
    return PieceEncoder(model)


@lru_cache(maxsize=2)
def memory_of(model: str | None, words: int = REMEMBERED) -> WordMemory:
    encoder = encoder_of(model)

    def make(words: list[bytes]) -> list[tuple[bytes, bytes]]:
        made = (encoder.unit(SPACE_MARK + w.decode()) for w in words)
        return [(m[0], m[1].encode()) for m in made]

    return WordMemory(make, (np.int32, np.uint8), words=words)


def plain(text: bytes) -> bool:
    """Whether the text's units are its words between single spaces."""
    return bool(text) and b"  " not in text and text[0] != 32 and text[-1] != 32 and _MARK_BYTES not in text


def encode_run(texts: list[bytes], encoder: PieceEncoder, memory: WordMemory) -> Iterator[tuple[np.ndarray, bytes]]:
    """Ids, and their decimal text with a comma after each, of each text."""
    easy = [t for t in texts if encoder.separable and plain(t)]
    parts: Iterator = iter(())
    if easy:
        words = Words(easy, byte_table(b" "), b" ")
        places = memory.places(words, words.hashes())
        cut = []
        for k in range(2):
            items, counts = memory.lay_out(k, places)
            ends = np.concatenate(([0], np.cumsum(counts)))[words.first]
            cut.append((items, ends.tolist()))
        (ids, at), (digits, of) = cut
        raw = digits.tobytes()
        parts = ((ids[a:b], raw[c:d]) for a, b, c, d in zip(at, at[1:], of, of[1:], strict=False))
    for t in texts:
        if encoder.separable and plain(t):
            yield next(parts)
        else:
            packed, decimal, _ = encoder.encode(t.decode())
            yield np.frombuffer(packed, np.int32), decimal.encode()


SCHEMA = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_pieces(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), model: str | None = None, ids: bool = False, remember: int = REMEMBERED) -> DataFrame:
    """Columns ``keep``, n_tokens, ids_sha256, decoded_sha256 and, with ``ids``, the ids, for every row.

    A null text counts as empty and has no tokens. Each row is encoded alone, so repeated rows give repeated
    results; other columns aren't read. ``model``: a SentencePiece model of the merge type, on every executor. ``remember``
    trades a worker's memory for speed and changes no result.
    """
    bounded_batches(docs.sparkSession)
    kept = docs.select(*(docs[c] for c in keep), docs[text].alias("__text"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]), SCHEMA, *(["ids array<int>"] * ids)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, memory = encoder_of(model), memory_of(model, remember)
        decode = encoder.library.decode
        for batch in batches:
            texts = texts_of(batch.column("__text"))
            for i, j in slices(texts):
                numbers, digests, decoded, all_ids = [], [], [], []
                for own, decimal in encode_run(texts[i:j], encoder, memory):
                    numbers.append(len(own))
                    digests.append(hashlib.sha256(decimal[:-1]).hexdigest())
                    decoded.append(hashlib.sha256((decode(own.tolist()) if len(own) else "").encode()).hexdigest())
                    if ids:
                        all_ids.append(own)
                out = [pa.array(numbers, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string()), *([pa.array(all_ids, pa.list_(pa.int32()))] if ids else [])]
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *out], [*keep, "n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if ids else [])])

    return kept.mapInArrow(lean(run), schema)

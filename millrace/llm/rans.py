"""Token ids in binary files: range asymmetric numeral systems with static tables.

A file holds the ids of consecutive documents. All its blocks share one frequency table; each block is coded alone
by LANES interleaved coders, and its final states, its place in the word stream and a checksum of its ids are in the
file's index, so blocks can be decoded in parallel and from any checkpoint. Coding is vectorised over blocks and lanes.

Files are decoded by segments, runs of documents of about SEGMENT_IDS ids: a task reads a file's index, the words of the
blocks that its segment touches, and nothing else. Which segments there are is a table that writing the files gives.

Layout (little endian): magic, a JSON header behind its length (uint32) and crc32 (uint32), then the sections that
the header lists with their types and lengths: alphabet, freqs, block_words, block_crc, states, doc_ids, doc_null,
doc_tokens and, last, words. The header has a crc32 of all sections but the words, which block_crc guards.
"""

from __future__ import annotations

import json
import os
import struct
import unicodedata
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WordMemory, Words, bounded_batches, lean, materialize, scratch, slices, texts_of

MAGIC = b"MRANS\x00\x00\x02"
#: Frequencies of a table add up to 2 ** PRECISION.
PRECISION = 20
LANES = 32
STEPS = 512
BLOCK = LANES * STEPS
LOWEST = 1 << 31
#: A file is closed when it holds this many ids, and a segment of it when it does.
FILE_IDS = 4_000_000
SEGMENT_IDS = 1_000_000
SECTIONS = (
    ("alphabet", "<u4"), ("freqs", "<u4"), ("block_words", "<u4"), ("block_crc", "<u4"), ("states", "<u8"),
    ("doc_ids", "<i8"), ("doc_null", "u1"), ("doc_tokens", "<u4"), ("words", "<u4"),
)


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Whole numbers of at least 1 in proportion to counts, adding up to 2 ** PRECISION."""
    whole = 1 << PRECISION
    if len(counts) > whole // 2:
        raise ValueError("more different ids than a table has room for")
    out = np.maximum(1, (counts.astype(np.float64) * whole / counts.sum()).astype(np.int64))
    over = int(out.sum()) - whole
    for i in np.argsort(-out, kind="stable"):
        if not over:
            break
        change = min(over, int(out[i]) // 2) if over > 0 else over
        out[i] -= change
        over -= change
    return out


def encode_ids(ids: np.ndarray) -> dict[str, np.ndarray]:
    """Sections of the coded ids (uint32); an empty array has none but empty ones."""
    if not len(ids):
        return {name: np.empty(0, dtype=kind) for name, kind in SECTIONS if not name.startswith("doc_")}
    if int(ids.max()) < 1 << 20:
        counts = np.bincount(ids)
        alphabet = np.flatnonzero(counts)
        counts, place = counts[alphabet], np.cumsum(counts > 0) - 1
        symbols = place[ids]
    else:
        alphabet, symbols, counts = np.unique(ids, return_inverse=True, return_counts=True)
    freqs = frequencies(counts)
    blocks = -(-len(ids) // BLOCK)
    padded = np.zeros(blocks * BLOCK, dtype=np.int64)
    padded[: len(ids)] = symbols
    steps = padded.reshape(blocks, STEPS, LANES).transpose(1, 0, 2)
    f = freqs.astype(np.uint64)
    base = np.concatenate(([0], np.cumsum(freqs)[:-1])).astype(np.uint64)
    limit = f << np.uint64(63 - PRECISION)
    x = np.full((blocks, LANES), LOWEST, dtype=np.uint64)
    sent = np.zeros((STEPS, blocks, LANES), dtype=bool)
    low = np.zeros((STEPS, blocks, LANES), dtype=np.uint32)
    for t in range(STEPS - 1, -1, -1):
        s = steps[t]
        fs = f[s]
        np.greater_equal(x, limit[s], out=sent[t])
        low[t] = x.astype(np.uint32)
        x = np.where(sent[t], x >> np.uint64(32), x)
        q = x // fs
        x = (q << np.uint64(PRECISION)) + (x - q * fs) + base[s]
    in_order = sent.transpose(1, 0, 2)
    crc = [zlib.crc32(ids[k * BLOCK : (k + 1) * BLOCK].astype("<u4").tobytes()) for k in range(blocks)]
    return {
        "alphabet": alphabet.astype("<u4"), "freqs": freqs.astype("<u4"), "block_words": in_order.sum((1, 2)).astype("<u4"),
        "block_crc": np.array(crc, dtype="<u4"), "states": x.astype("<u8").reshape(-1), "words": low.transpose(1, 0, 2)[in_order].astype("<u4"),
    }


def decode_blocks(parts: dict[str, np.ndarray], n_ids: int, first: int = 0, last: int | None = None, words: np.ndarray | None = None) -> np.ndarray:
    """Ids of blocks first..last-1 (all by default), each checked against its crc32; ``words``: those of these blocks alone."""
    total = len(parts["block_words"])
    last = total if last is None else last
    blocks = last - first
    if blocks <= 0:
        return np.empty(0, dtype=np.uint32)
    freqs = parts["freqs"].astype(np.uint64)
    base = np.concatenate(([0], np.cumsum(freqs)[:-1])).astype(np.uint64)
    symbol_of = np.repeat(np.arange(len(freqs)), freqs.astype(np.int64))
    places = word_places(parts)
    at = places[first:last] - (0 if words is None else places[first])
    words = np.concatenate((parts["words"] if words is None else words, np.zeros(LANES, dtype="<u4"))).astype(np.uint64)
    x = parts["states"].reshape(total, LANES)[first:last].astype(np.uint64)
    out = np.empty((STEPS, blocks, LANES), dtype=np.uint32)
    mask = np.uint64((1 << PRECISION) - 1)
    for t in range(STEPS):
        slot = x & mask
        s = symbol_of[slot.astype(np.int64)]
        out[t] = s
        x = freqs[s] * (x >> np.uint64(PRECISION)) + slot - base[s]
        need = x < LOWEST
        rank = np.cumsum(need, axis=1)
        x = np.where(need, (x << np.uint64(32)) | words[np.minimum(at[:, None] + rank - 1, len(words) - 1)], x)
        at += rank[:, -1]
    ids = parts["alphabet"][out.transpose(1, 0, 2).reshape(-1)][: n_ids - first * BLOCK].astype("<u4")
    for k in range(blocks):
        if zlib.crc32(ids[k * BLOCK : (k + 1) * BLOCK].tobytes()) != parts["block_crc"][first + k]:
            raise ValueError(f"block {first + k} fails its checksum")
    return ids


def word_places(parts: dict[str, np.ndarray]) -> np.ndarray:
    """Where each block's words begin, and where they end after the last."""
    return np.concatenate(([0], np.cumsum(parts["block_words"].astype(np.int64))))


def pack_file(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    parts = encode_ids(ids)
    parts |= {"doc_ids": np.array([d or 0 for d in doc_ids], "<i8"), "doc_null": np.array([d is None for d in doc_ids], "u1"), "doc_tokens": np.array(lengths, "<u4")}
    sections = [[name, kind, len(parts[name])] for name, kind in SECTIONS]
    index = b"".join(parts[name].astype(kind).tobytes() for name, kind in SECTIONS[:-1])
    head = json.dumps({"ids": len(ids), "precision": PRECISION, "lanes": LANES, "steps": STEPS, "sections": sections, "index_crc": zlib.crc32(index)}).encode()
    return b"".join([MAGIC, struct.pack("<II", len(head), zlib.crc32(head)), head, index, parts["words"].astype("<u4").tobytes()])


def read_header(content: bytes) -> dict:
    """The header of a file that begins with this; with ``begin`` and ``words``: where the index and the words begin."""
    if content[:8] != MAGIC:
        raise ValueError("not a file of this format")
    size, crc = struct.unpack_from("<II", content, 8)
    if zlib.crc32(content[16 : 16 + size]) != crc:
        raise ValueError("the header fails its checksum")
    head = json.loads(content[16 : 16 + size])
    if (head["precision"], head["lanes"], head["steps"]) != (PRECISION, LANES, STEPS):
        raise ValueError("other coding parameters than this reader's")
    head["begin"] = 16 + size
    head["words"] = head["begin"] + sum(np.dtype(kind).itemsize * n for _, kind, n in head["sections"][:-1])
    return head


def read_index(head: dict, index: bytes) -> dict[str, np.ndarray]:
    """All sections but the words, as views."""
    if zlib.crc32(index) != head["index_crc"]:
        raise ValueError("the index fails its checksum")
    at, parts = 0, {}
    for name, kind, n in head["sections"][:-1]:
        parts[name] = np.frombuffer(index, dtype=kind, count=n, offset=at)
        at += parts[name].nbytes
    return parts


def read_file(content: bytes) -> tuple[dict, dict[str, np.ndarray]]:
    """Header and all sections of a whole file."""
    head = read_header(content)
    parts = read_index(head, content[head["begin"] : head["words"]])
    return head, parts | {"words": np.frombuffer(content, "<u4", offset=head["words"])}


def read_segment(store: pyarrow.fs.FileSystem, path: str, first_doc: int, n_docs: int) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The index of a file, and the ids of some of its documents, from their checkpoints on."""
    with store.open_input_file(path) as f:
        start = f.read_at(16, 0)
        size = struct.unpack_from("<I", start, 8)[0] if start[:8] == MAGIC else 0
        head = read_header(start + f.read_at(size, 16))
        parts = read_index(head, f.read_at(head["words"] - head["begin"], head["begin"]))
        ends = np.cumsum(parts["doc_tokens"].astype(np.int64))
        a, b = int(ends[first_doc - 1]) if first_doc else 0, int(ends[first_doc + n_docs - 1])
        first, last = a // BLOCK, -(-b // BLOCK)
        places = word_places(parts)
        words = np.frombuffer(f.read_at(4 * int(places[last] - places[first]), head["words"] + 4 * int(places[first])), "<u4")
    return parts, decode_blocks(parts, head["ids"], first, last, words)[a - first * BLOCK : b - first * BLOCK]


#: How the tokenizer splits (fixed value), and the same in this library's syntax for text without apostrophes.
SPLIT = r"[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
PIECES = regex.compile(r"\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
OTHER_SPACE = regex.compile(r"\s")
INNER_SPACE = regex.compile(r"[^\S\n]")
#: Pieces that a worker remembers besides its runs. It changes speed, never results.
MOST_PIECES = 300_000


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordTokens:
    """Ids of whole texts, by runs between ASCII white space: the tokenizer splits there, so each run has its own ids.

    A new run is split further, as the tokenizer would, into letters, digits and signs; many new pieces are encoded in
    one call and told apart by the ids that end a word. Where that isn't certain to be the same, the run itself is
    encoded. What is remembered changes speed, never results.
    """

    def __init__(self, path: str | None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tokenizers

        self.library = tokenizers.Tokenizer.from_file(path or default_tokenizer())
        tokens = self.library.get_vocab()
        self.ends = np.zeros(max(tokens.values()) + 1, dtype=bool)
        self.ends[[i for t, i in tokens.items() if t.endswith("</w>")]] = True
        self.specials = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        spec = json.loads(self.library.to_str())
        #: The split below is that of this pre-tokenizer and of no other.
        self.splits = spec["model"].get("end_of_word_suffix") == "</w>" and SPLIT in json.dumps(spec["pre_tokenizer"], ensure_ascii=False)
        self.memory = WordMemory(self.runs, (np.uint32,))
        self.known: dict[str, bytes] = {}

    def one_by_one(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def split(self, run: bytes) -> list[str] | None:
        """The tokenizer's pieces of a run; None if only it can tell."""
        if not self.splits or b"'" in run or any(t in run for t in self.specials):
            return None
        text = run.decode()
        if run.isascii():
            return PIECES.findall(text.lower())
        low = text.lower()
        if len(low) != len(text) or "\u03a3" in text or not (unicodedata.is_normalized("NFC", text) and unicodedata.is_normalized("NFC", low)) or OTHER_SPACE.search(text):
            return None
        return PIECES.findall(low)

    def split_all(self, new: list[bytes]) -> list[list[str] | None]:
        """``split`` of each run; runs that are plain when taken together are lower-cased in one step."""
        parts: list[list[str] | None] = [None] * len(new)
        if not self.splits:
            return parts
        joined = b"\n".join(new)
        special = any(t in joined for t in self.specials)
        easy = [i for i, w in enumerate(new) if b"'" not in w and not (special and any(t in w for t in self.specials))]
        text = "\n".join([new[i].decode() for i in easy]) if len(easy) < len(new) else joined.decode()
        low = text.lower()
        plain = text.isascii() or (
            len(low) == len(text) and "\u03a3" not in text and unicodedata.is_normalized("NFC", text) and unicodedata.is_normalized("NFC", low) and not INNER_SPACE.search(text)
        )
        if not plain:
            for i in easy:
                parts[i] = self.split(new[i])
        elif easy:
            for i, w in zip(easy, low.split("\n"), strict=True):
                parts[i] = [w] if w.isalpha() else PIECES.findall(w)
        return parts

    def pieces(self, wanted: set[str]) -> dict[str, bytes]:
        """Ids of pieces, at least of those wanted; some are remembered from run to run."""
        if len(self.known) > MOST_PIECES:
            self.known.clear()
        known = self.known
        new = [p for p in wanted if p not in known]
        for at in range(0, len(new), 2_000):
            part = new[at : at + 2_000]
            ids = np.array(self.library.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, dtype="<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(part) and cuts[-1] == len(ids):
                raw, last = ids.tobytes(), 0
                for p, cut in zip(part, (4 * cuts).tolist(), strict=True):
                    known[p] = raw[last:cut]
                    last = cut
            else:
                known.update(zip(part, self.one_by_one(part), strict=True))
        return known

    def runs(self, new: list[bytes]) -> list[tuple[bytes]]:
        """Ids of each new run."""
        parts = self.split_all(new)
        pieces = self.pieces({p for ps in parts if ps for p in ps})
        hard = iter(self.one_by_one([w.decode() for w, ps in zip(new, parts, strict=True) if ps is None]))
        return [(next(hard),) if ps is None else (pieces[ps[0]],) if len(ps) == 1 else (b"".join([pieces[p] for p in ps]),) for ps in parts]

    def encode(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For runs of texts: the ids of them all, and how many each text has."""
        for i, j in slices(texts):
            words = Words(texts[i:j])
            ids, counts = self.memory.lay_out(0, self.memory.places(words, words.hashes()))
            sums = np.concatenate(([0], np.cumsum(counts)))
            yield ids, np.diff(sums[words.first])


@lru_cache(maxsize=2)
def tokens_of(path: str | None) -> WordTokens:
    return WordTokens(path)


def put(uri: str, name: str, content: bytes) -> None:
    """Writes under another name first: a lost or repeated attempt leaves the whole file or none."""
    store, path = pyarrow.fs.FileSystem.from_uri(uri)
    store.create_dir(path, recursive=True)
    held = f"{path}/_{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(held) as out:
        out.write(content)
    store.move(held, f"{path}/{name}")


def parts_of(ids: list[int | None], ties: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """The range of each row between the sorted cuts; rows whose id is a cut are spread, by their text's hash, over all
    ranges that the cut ends or begins, so an id that a third of all rows have takes a third of the ranges. Null is least."""
    own = np.array([NULL_ID if d is None else d for d in ids], dtype=np.float64)
    low, high = np.searchsorted(cuts, own, side="left"), np.searchsorted(cuts, own, side="right")
    exact = (np.abs(own) < 2**53) | (own == NULL_ID)  # beyond, different ids can look equal here
    return np.where(exact, low + (((high - low + 1) * ties.astype(np.int64)) >> 32), high).astype(np.int32)


#: What a null id counts as when ranges are made.
NULL_ID = float(-(2**63))
SEGMENTS = "file string, part int, segment int, first_doc long, n_docs long, n_tokens long"


def encode_documents(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 2, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Writes the files under ``path`` and returns a row for each segment of them: file, part, segment, first_doc, n_docs,
    n_tokens. Runs at once; the rows are a table in the shared folder and never come to the driver.

    Documents are in ascending order of id over the files in their order (null ids first, equal ids by their texts' crc32).
    A null text counts as empty and has only the end id.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    kept = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("__text"))
    parts = max(1, kept.rdd.getNumPartitions())
    ids = kept.select(F.coalesce(F.col("doc_id").cast("double"), F.lit(NULL_ID)).alias("id"))
    cuts = np.array(ids.approxQuantile("id", [k / parts for k in range(1, parts)], 0.2 / parts) if parts > 1 else [], dtype=np.float64)

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(tokenizer)
        small = tokens.library.get_vocab_size() <= 1 << 16 and end_id < 1 << 16
        for batch in batches:
            texts = texts_of(batch.column("__text"))
            tie = np.fromiter(map(zlib.crc32, texts), np.int64, len(texts))
            place = parts_of(batch.column("doc_id").to_pylist(), tie, cuts)
            ids = []
            for run, counts in tokens.encode(texts):
                raw, wide = (run.astype("<u2") if small else run).tobytes(), 2 if small else 4
                ends = np.cumsum(counts) * wide
                ids += [raw[a:b] for a, b in zip((ends - counts * wide).tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(place), batch.column("doc_id"), pa.array(tie), pa.array(ids, pa.binary()), pa.array([small] * len(ids))], ["part", "doc_id", "tie", "ids", "small"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc_ids: list[int | None] = []
        lengths: list[int] = []
        held: list[np.ndarray] = []
        part, count, number = -1, 0, 0
        end = np.array([end_id], dtype=np.uint32)

        def close() -> pa.RecordBatch:
            name = f"part-{part:06d}-{number:04d}.rans"
            put(path, name, pack_file(doc_ids, lengths, np.concatenate(held)))
            # the segment of a document: how often SEGMENT_IDS fits into what stands before it
            before = np.cumsum(lengths) - lengths
            first = np.flatnonzero(np.diff(before // SEGMENT_IDS, prepend=-1))
            n_docs = np.diff(np.append(first, len(lengths)))
            n = len(first)
            columns = [pa.array([name] * n), pa.array([part] * n, pa.int32()), pa.array(range(n), pa.int32()), pa.array(first), pa.array(n_docs), pa.array(np.add.reduceat(lengths, first).astype(np.int64))]
            for x in (doc_ids, lengths, held):
                x.clear()
            return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in SEGMENTS.split(", ")])

        for batch in batches:
            for p, d, x, small in zip(*(batch.column(c).to_pylist() for c in ("part", "doc_id", "ids", "small")), strict=True):
                if doc_ids and (p != part or count >= FILE_IDS):
                    yield close()
                    number, count = (number + 1 if p == part else 0), 0
                part = p
                doc_ids.append(d)
                held += [np.frombuffer(x, "<u2" if small else "<u4").astype(np.uint32), end]
                lengths.append(len(held[-2]) + 1)
                count += lengths[-1]
        if doc_ids:
            yield close()

    ready = kept.mapInArrow(lean(tokenise), "part int, doc_id long, tie long, ids binary, small boolean")
    ready = ready.repartitionById(len(cuts) + 1, "part").sortWithinPartitions("part", F.col("doc_id").asc_nulls_first(), "tie", "ids")
    return materialize(ready.mapInArrow(lean(write), SEGMENTS), "rans-segments")


def decode_documents(segments: DataFrame, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, file for every document of the files that ``segments`` lists, and of no others.

    ``start`` counts the ids before a document over all listed files in order of part and file. Where each segment begins is
    summed up by part first, so a single task sees one row for each part.
    """
    totals = segments.groupBy("part").agg(F.sum("n_tokens").alias("n"), F.count(F.lit(1)).alias("k"))
    every, own = Window.orderBy("part"), Window.partitionBy("part").orderBy("file", "segment")
    before = totals.select("part", (F.sum("n").over(every) - F.col("n")).alias("tokens_before"), (F.sum("k").over(every) - F.col("k")).alias("segments_before"))
    placed = segments.join(before, "part")
    start = F.col("tokens_before") + F.sum("n_tokens").over(own) - F.col("n_tokens")
    placed = placed.select("file", "first_doc", "n_docs", start.alias("start"), (F.col("segments_before") + F.row_number().over(own)).alias("at"))
    # a task has about as many ids as a file, be it in one segment or in several; what it holds at once is one segment
    tasks = min(-(-int(segments.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]) // FILE_IDS) or 1, 100_000)
    dealt = placed.repartitionById(tasks, F.pmod("at", F.lit(tasks)).cast("int"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pyarrow.fs.FileSystem.from_uri(path)
        for batch in batches:
            for name, first, n, start in zip(*(batch.column(c).to_pylist() for c in ("file", "first_doc", "n_docs", "start")), strict=True):
                parts, ids = read_segment(store, f"{base}/{name}", first, n)
                lengths = parts["doc_tokens"][first : first + n].astype(np.int64)
                ends = np.cumsum(lengths)
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * (e - k) : 4 * e]) for e, k in zip(ends.tolist(), lengths.tolist(), strict=True)]
                doc_ids = pa.array(parts["doc_ids"][first : first + n], mask=parts["doc_null"][first : first + n].astype(bool))
                out = [doc_ids, pa.array(start + ends - lengths), pa.array(lengths), pa.array(crc, pa.int64()), pa.array([name] * len(crc), pa.string())]
                yield pa.RecordBatch.from_arrays(out, ["doc_id", "start", "n_tokens", "ids_crc32", "file"])

    return dealt.mapInArrow(lean(read), "doc_id long, start long, n_tokens long, ids_crc32 long, file string")


def round_trip(docs: DataFrame, tokenizer: str | None = None, end_id: int = 2, path: str | None = None) -> DataFrame:
    """Encodes ``docs`` into files, in the shared folder unless ``path`` names another, and reads them back.

    Every row has its result; repeated ids stand beside each other in the files. An empty table writes no file. Files that
    lay in ``path`` before are replaced if they have a new one's name and are left alone otherwise; they are never read.
    """
    path = path or scratch(docs.sparkSession, "rans")
    return decode_documents(encode_documents(docs, path, tokenizer, end_id), path)

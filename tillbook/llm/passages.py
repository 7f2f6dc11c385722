"""Removal of byte strings that documents with smaller ids hold as well, by suffix sorting.

Whole texts can't be sorted together on a cluster, and need not be. Each window of ``LENGTH`` bytes has an anchor, its
leftmost smallest gram by a hash, so equal windows have equal anchors at equal places.

1. Tasks hash all grams. Hashes of anchors go, a few bytes each, to buckets that find those in two texts or more.
   Copies of a whole text are found by its digest; their smallest document takes part, the others go as a whole.
2. Documents get their shared anchors back and send each with its context, the bytes that the windows around it cover.
   Equal contexts are one row per chunk of documents.
3. Contexts arrive sorted by anchor. Copies of a context are settled at once. Anchors whose contexts differ are gathered
   to blocks of bounded size whose suffixes are sorted (``suffix_groups``); neighbours in that order that agree over a
   window's length hold the same string, and the smallest document among them keeps it. An anchor with more contexts
   than ``MOST_CONTEXTS`` is streamed on window by window and settled by grouping the windows' bytes.
4. Documents get the windows to remove.

Nothing is sampled and no group is held whole: an anchor that a third of all documents share is a row per chunk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.llm.common import lean, lean_stream, shuffle_partitions, stored
from tillbook.llm.suffix_groups import suffix_order

LENGTH = 50
GRAM = 28
SPAN = LENGTH - GRAM + 1  # grams in a window, and symbols in one whose anchor is a single symbol

#: Text bytes for each chunk of documents and, over it, hashed at a time; symbols of a block; contexts of an anchor held at a time.
CHUNK_BYTES = 4 << 20
PART_BYTES = 1 << 17
BLOCK = 1 << 15
MOST_CONTEXTS = 2048

_LOW = np.uint64((1 << 40) - 1)
_PLACE_BITS = 40


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the gram at each place: a polynomial over mixed bytes, built by doubling, mixed once more."""
    odd = np.uint64(0x9E3779B97F4A7C15)
    table = (np.arange(256, dtype=np.uint64) + np.uint64(1)) * odd
    table ^= table >> np.uint64(29)
    power, size = np.uint64(0xD6E8FEB86659FD93), 1
    doubled, whole, covered = table[data], None, 0
    with np.errstate(over="ignore"):
        rest = GRAM
        while rest:
            if rest & 1:
                part = doubled[covered:]
                whole = part if whole is None else whole[: len(part)] * power + part
                covered += size
            rest >>= 1
            if rest:
                doubled = doubled[:-size] * power + doubled[size:]
                power, size = power * power, size * 2
        whole ^= whole >> np.uint64(32)
        whole *= odd
        return whole ^ whole >> np.uint64(29)


def _windows_minimum(values: np.ndarray) -> np.ndarray:
    n, least, size = len(values) - SPAN + 1, values, 1
    while size * 2 <= SPAN:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    return np.minimum(least[:n], least[SPAN - size : SPAN - size + n])


def anchors(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, low, high, anchor, hash) for texts ``data[bounds[i]:bounds[i + 1]]``: windows low..high-1 have that anchor."""
    count = np.maximum(np.diff(bounds) - LENGTH + 1, 0)
    if not count.sum():
        return tuple(np.zeros(0, kind) for kind in (np.int64, np.int64, np.int64, np.int64, np.uint64))
    hashes = gram_hashes(data)
    least = _windows_minimum(hashes)
    new = np.concatenate(([True], least[1:] != least[:-1]))
    texts = np.flatnonzero(count)
    begin, end = bounds[texts], bounds[texts] + count[texts]
    new[begin] = True
    new[end[end < len(new)]] = True
    low = np.flatnonzero(new)
    high = np.concatenate((low[1:], [len(new)]))
    own = np.searchsorted(begin, low, side="right") - 1
    inside = (own >= 0) & (low < end[own])  # other windows reach over the end of a text
    text, low, high = texts[own[inside]], low[inside], high[inside]
    least, found = least[low], []
    grams = np.lib.stride_tricks.sliding_window_view(hashes, SPAN)
    while len(low):
        at = low + grams[low].argmin(axis=1)
        found.append((text, low, np.minimum(high, at + 1), at, least))
        more = high > at + 1  # the same gram again further on
        text, low, high, least = text[more], at[more] + 1, high[more], least[more]
    columns = [np.concatenate(x) for x in zip(*found, strict=True)]
    if len(found) > 1:
        order = np.argsort(columns[1], kind="stable")
        columns = [x[order] for x in columns]
    return tuple(columns)


def _parts(bounds: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(first text, last text + 1, bytes skipped in the first): texts hashed together; long ones in overlapping parts."""
    i = 0
    while i < len(bounds) - 1:
        size = int(bounds[i + 1] - bounds[i])
        if size > 2 * PART_BYTES:
            for skip in range(0, size - LENGTH + 1, PART_BYTES):
                yield i, i + 1, skip
            i += 1
            continue
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + PART_BYTES, side="right")) - 1)
        while j > i + 1 and bounds[j] - bounds[j - 1] > 2 * PART_BYTES:
            j -= 1
        yield i, j, 0
        i = j


def all_anchors(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """``anchors`` of any number of texts of any length, places counted from the start of ``data``."""
    found = []
    for i, j, skip in _parts(bounds):
        cut = bounds[i : j + 1].copy()
        cut[0] += skip
        if j == i + 1:
            cut[1] = min(cut[1], cut[0] + PART_BYTES + LENGTH - 1) if bounds[j] - bounds[i] > 2 * PART_BYTES else cut[1]
        text, low, high, at, least = anchors(data[cut[0] : cut[-1]], cut - cut[0])
        found.append((text + i, low + cut[0], high + cut[0], at + cut[0], least))
    if not found:
        return anchors(data, np.zeros(1, np.int64))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _numbered(text: np.ndarray) -> np.ndarray:
    """Place of each anchor among those of its text, texts being together."""
    first = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1]))) if len(text) else np.zeros(0, np.int64)
    return np.arange(len(text)) - np.repeat(first, np.diff(np.concatenate((first, [len(text)]))))


def _planes(values: np.ndarray) -> bytes:
    """Bytes of numbers by significance, so that the high ones compress to nothing."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_planes(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _listed(doc: np.ndarray, number: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Runs of equal documents: ids, lengths of runs, numbers as steps."""
    first = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    steps = np.diff(number, prepend=0)
    steps[first] = number[first]
    return doc[first].tobytes(), _planes(np.diff(np.concatenate((first, [len(doc)])))), _planes(steps)


def _unlisted(ids: bytes, runs: bytes, steps: bytes) -> tuple[np.ndarray, np.ndarray]:
    runs, steps = _from_planes(runs), _from_planes(steps)
    total = np.cumsum(steps)
    before = np.cumsum(runs) - runs
    base = total[before] - steps[before]
    return np.repeat(np.frombuffer(ids, np.int64), runs), total - np.repeat(base, runs)


_LISTS = "ids binary, runs binary, steps binary"


def _by(key: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(key, rows) with rows in their order."""
    if not len(key):
        return
    short = key.astype(np.uint16) if 0 <= key.min() and key.max() < 1 << 16 else key  # sorted by digits
    order = np.argsort(short, kind="stable")
    first = np.flatnonzero(np.concatenate(([True], key[order][1:] != key[order][:-1])))
    for a, b in zip(first, [*first[1:], len(key)], strict=True):
        yield int(key[order[a]]), order[a:b]


def _buffer(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a binary column and where each value begins, nulls as empty ones."""
    values = [x or b"" for x in column.to_pylist()]
    bounds = np.concatenate(([0], np.cumsum(np.fromiter(map(len, values), np.int64, len(values)))))
    return np.frombuffer(b"".join(values), np.uint8), bounds.astype(np.int64)


def _batch(columns: dict[str, list], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[c], k) for c, k in kinds.items()], names=list(kinds))


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch of (id, bytes) in slices of about a chunk's size."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, before + CHUNK_BYTES, side="right")))
        yield batch.slice(at, end - at)
        at = end


def text_hash(text: bytes) -> int:
    return xxhash.xxh64_intdigest(text, 42)


def _of_several_texts(
    gram: np.ndarray, text: np.ndarray, doc: np.ndarray, several: np.ndarray | None = None
) -> tuple[np.ndarray, ...]:
    """(alone, order, new): rows whose gram no other has; the others by gram, text and document with whole copies left
    out, and where grams begin among them; of these only those in several texts. ``several`` marks rows whose gram
    another text is known to have."""
    order = np.argsort(gram, kind="stable")
    if not len(order):
        return order, order, np.zeros(0, bool)
    ranked = gram[order]
    new = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    single = new & np.concatenate((new[1:], [True]))
    alone, order, ranked = order[single], order[~single], ranked[~single]
    order = order[np.lexsort((doc[order], text[order], ranked))]
    new = np.concatenate(([True], ranked[1:] != ranked[:-1]))[: len(order)]
    del ranked
    new_text = new | np.concatenate(([True], text[order][1:] != text[order][:-1]))[: len(order)]
    first_doc = doc[order][np.maximum.accumulate(np.where(new_text, np.arange(len(order)), 0))]
    of_gram = np.cumsum(new) - 1
    texts = np.bincount(of_gram[new_text])
    if several is not None:
        texts[of_gram[several[order]]] += 1
    own = doc[order] == first_doc
    many = (texts > 1)[of_gram[own]] if len(order) else own
    order, new = order[own], new[own]
    return np.concatenate((alone, order[~many])), order[many], new[many]


def _joined(values: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of all pairs with ``values[i] == names[j]``."""
    order = np.argsort(names, kind="stable")
    low, high = (np.searchsorted(names[order], values, side=side) for side in ("left", "right"))
    count = high - low
    i = np.repeat(np.arange(len(values)), count)
    within = np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)
    return i, order[np.repeat(low, count) + within]


def _shared(docs: DataFrame, buckets: int, chunks: int) -> DataFrame:
    """Lists, by chunk, of the anchors' numbers in each document whose hash another text has too.

    Copies of a whole text share all their anchors, so wherever one of them turns up all others do, and only the
    smallest goes on.
    """
    kinds = {"bucket": pa.int32(), **dict.fromkeys(("ids", "runs", "steps", "texts", "grams", "several"), pa.binary())}

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _slices(whole)):
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            copies = np.array([text_hash(x or b"") for x in batch.column(1).to_pylist()], np.uint64)
            row, _, _, _, least = all_anchors(*_buffer(batch.column(1)))
            doc, text, number = ids[row], copies[row], _numbered(row)
            alone, shared, new_gram = _of_several_texts(least, text, doc)
            several = np.zeros(len(least), bool)
            several[shared] = True
            out: dict[str, list] = {name: [] for name in kinds}

            def add(bucket: int, rows: np.ndarray, with_grams: bool) -> None:
                rows = np.sort(rows)
                lists = _listed(doc[rows], number[rows])
                firsts = np.concatenate(([True], doc[rows][1:] != doc[rows][:-1]))
                grams = (least[rows] & _LOW).view(np.uint8).reshape(-1, 8)[:, :5].tobytes() if with_grams else None
                marks = np.packbits(several[rows]).tobytes() if with_grams else None
                values = (bucket, *lists, text[rows][firsts].tobytes(), grams, marks)
                for column, value in zip(out.values(), values, strict=True):
                    column.append(value)

            # those in several texts here are known to be shared; one of them, marked so, stands for them elsewhere
            rows = np.concatenate((alone, shared[new_gram]))
            for bucket, own in _by((least[rows] >> np.uint64(40)).astype(np.int64) % buckets):
                add(bucket, rows[own], True)
            rows = shared
            for bucket, own in _by(doc[rows] % buckets):
                add(bucket, rows[own], False)
            yield _batch(out, kinds)

    out_kinds = {"chunk": pa.int64(), **dict.fromkeys(("ids", "runs", "steps"), pa.binary())}

    def matched(table: pa.Table) -> pa.Table:
        known, sent = [], []
        for row in (row for k in range(0, table.num_rows, 16) for row in table.slice(k, 16).to_pylist()):
            doc, number = _unlisted(row["ids"], row["runs"], row["steps"])
            if row["grams"] is None:
                known.append((doc, number))
                continue
            wide = np.zeros((len(doc), 8), np.uint8)
            wide[:, :5] = np.frombuffer(row["grams"], np.uint8).reshape(-1, 5)
            text = np.repeat(np.frombuffer(row["texts"], np.uint64), _from_planes(row["runs"]))
            several = np.unpackbits(np.frombuffer(row["several"], np.uint8), count=len(doc)).astype(bool)
            sent.append((doc, number, text, wide.view("<u8").ravel(), several))
        if sent:
            columns = [np.concatenate(x) for x in zip(*sent, strict=True)]
            sent.clear()  # a bucket's rows are held once
            doc, number, text, gram, several = columns
            _, shared, _ = _of_several_texts(gram, text, doc, several)
            known.append((doc[shared], number[shared]))
            del columns, doc, number, text, gram, several, shared
        doc, number = (np.concatenate(x) for x in zip(*known, strict=True))
        order = np.lexsort((number, doc))
        doc, number = doc[order], number[order]
        out: dict[str, list] = {name: [] for name in out_kinds}
        for chunk, rows in _by(doc % chunks):
            for column, value in zip(out.values(), (chunk, *_listed(doc[rows], number[rows])), strict=True):
                column.append(value)
        return pa.Table.from_batches([_batch(out, out_kinds)])

    sent = docs.mapInArrow(lean_stream(hashed), f"bucket int, {_LISTS}, texts binary, grams binary, several binary")
    return sent.groupBy("bucket").applyInArrow(lean(matched), f"chunk long, {_LISTS}")


def _copies(docs: DataFrame, chunks: int) -> DataFrame:
    """Lists by chunk of the documents whose whole text a smaller one has: (document, hash of the text, -1)."""
    rows = docs.filter(F.octet_length("bytes") >= LENGTH).select(
        "doc_id", F.xxhash64("bytes").alias("hash"), F.sha2("bytes", 256).alias("digest")
    )
    least = rows.groupBy("digest").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    late = rows.join(least.filter("most > least"), "digest").filter("doc_id > least").distinct()
    return _as_lists(late.select("doc_id", "hash"), chunks, -1)


def _as_lists(rows: DataFrame, chunks: int, windows: int) -> DataFrame:
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = _Settled(chunks)
            docs, places = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            out.cover(docs, places, np.full(len(docs), windows))
            yield out.batch().select(["chunk", "docs", "places", "windows"])

    return rows.mapInArrow(listed, "chunk long, docs binary, places binary, windows binary")


def _variants(ids: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """0 for a document's first text, 1 for the next where rows repeat an id with other texts, and so on."""
    variant = np.zeros(len(ids), np.int64)
    if len(np.unique(ids)) < len(ids):
        for _, rows in _by(ids):
            order = {text: k for k, text in enumerate(sorted({texts[r] for r in rows}))}
            variant[rows] = [order[texts[r]] for r in rows]
    return variant


_CONTEXT = {"key": pa.int64(), "context": pa.binary(), "doc": pa.int64(), "place": pa.int64(), "windows": pa.int32()}


def _contexts(docs: DataFrame, shared: DataFrame) -> DataFrame:
    """A row for each shared anchor's context in a chunk; those of larger documents that repeat one come without it."""

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = left.column("doc_id").to_numpy()
        texts = [x or b"" for x in left.column("bytes").to_pylist()]
        variant = _variants(ids, texts)
        data, bounds = _buffer(left.column("bytes"))
        text, low, high, at, least = all_anchors(data, bounds)
        count = np.bincount(text, minlength=len(ids))
        before = np.cumsum(count) - count
        wanted = np.zeros(len(text), bool)
        asked = [_unlisted(*(lists[x] for x in ("ids", "runs", "steps"))) for lists in right.to_pylist()]
        if asked:
            doc, number = (np.concatenate(x) for x in zip(*asked, strict=True))
            i, row = _joined(doc, ids)
            fitting = number[i] < count[row]
            wanted[before[row[fitting]] + number[i[fitting]]] = True
        picked = np.flatnonzero(wanted)
        picked = picked[np.argsort(ids[text[picked]], kind="stable")]
        whole, digest = data.tobytes(), xxhash.xxh32_digest
        spans = (x[picked].tolist() for x in (low, high, at))
        # the anchor itself as four bytes, beside the eight of its hash
        contexts: list[bytes | None] = [
            b"%b%c%b%b" % (digest(whole[k : k + GRAM]), k - lo, whole[lo:k], whole[k + GRAM : hi - 1 + LENGTH])
            for lo, hi, k in zip(*spans, strict=True)
        ]
        key, doc = least[picked].view(np.int64).copy(), ids[text[picked]]
        seen: dict[tuple[int, bytes], int] = {}
        named = zip(key.tolist(), contexts, strict=True)
        first = np.fromiter((seen.setdefault(x, k) for k, x in enumerate(named)), np.int64, len(contexts))
        for k in np.flatnonzero(doc[first] < doc).tolist():
            key[k], contexts[k] = doc[k], None
        place = (variant[text[picked]] << _PLACE_BITS) + low[picked] - bounds[text[picked]]
        columns = (key, contexts, doc, place, (high - low)[picked])
        return pa.table({n: pa.array(x, kind) for (n, kind), x in zip(_CONTEXT.items(), columns, strict=True)})

    schema = "key long, context binary, doc long, place long, windows int"
    return docs.groupBy("chunk").cogroup(shared.groupBy("chunk")).applyInArrow(lean(cut), schema)


def _agreeing(contexts: list[bytes], group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many bytes before and how many behind its anchor each context has in common with some other of its group.

    No window that reaches further can be in another context. Zeros fill up short sides, so a side may seem to agree in
    more zeros than it does, never in fewer bytes.
    """
    side = SPAN - 1
    heads = group.astype(">u4").view(np.uint8).reshape(-1, 4)
    found = []
    for parts in ([c[4 + c[4] : 4 : -1] for c in contexts], [c[5 + c[4] :] for c in contexts]):
        filled = np.frombuffer(b"".join([x.ljust(side, b"\0") for x in parts]), np.uint8).reshape(-1, side)
        rows = np.concatenate((heads, filled, np.zeros((len(parts), 1), np.uint8)), axis=1)
        order = np.argsort(rows.view(f"S{side + 5}").ravel(), kind="stable")
        unlike = rows[order[1:]] != rows[order[:-1]]
        unlike[:, -1] = True
        common = np.maximum(unlike.argmax(axis=1) - 4, 0)
        most = np.zeros(len(parts), np.int64)
        most[order[:-1]] = common
        most[order[1:]] = np.maximum(most[order[1:]], common)
        found.append(np.minimum(most, np.fromiter(map(len, parts), np.int64, len(parts))))
    return found[0], found[1]


class _Settled:
    """Windows to remove and windows still open, handed on in batches."""

    kinds = {
        "chunk": pa.int64(), "docs": pa.binary(), "places": pa.binary(), "windows": pa.binary(),
        "window": pa.binary(), "doc": pa.int64(), "place": pa.int64(),
    }

    def __init__(self, chunks: int):
        self.chunks = chunks
        self.covered: list[np.ndarray] = []
        self.rows = 0
        self.open: list[tuple[int, bytes, int, list[int]]] = []
        self.windows = 0
        self.block: list[list] = []
        self.symbols = 0

    def cover(self, docs: np.ndarray, places: np.ndarray, windows: np.ndarray) -> None:
        """Remove so many windows of the documents from these places on."""
        if len(docs):
            self.covered.append(np.stack([docs, places, windows]).astype(np.int64))
            self.rows += len(docs)

    def batch(self) -> pa.RecordBatch:
        out: dict[str, list] = {name: [] for name in self.kinds}
        rows = np.concatenate([np.zeros((3, 0), np.int64), *self.covered], axis=1)
        for chunk, own in _by(rows[0] % self.chunks):
            lists = (chunk, *(row[own].tobytes() for row in rows), None, None, None)
            for column, value in zip(out.values(), lists, strict=True):
                column.append(value)
        lists, columns = _batch(out, self.kinds), self._opened()
        self.covered, self.rows, self.open, self.windows = [], 0, [], 0
        if not len(columns[0]):
            return lists
        rest = [pa.nulls(len(columns[0]), kind) for kind in list(self.kinds.values())[: -len(columns)]]
        joined = [pa.concat_arrays(x) for x in zip(lists.columns, [*rest, *columns], strict=True)]
        return pa.RecordBatch.from_arrays(joined, names=list(self.kinds))

    def _opened(self) -> list[pa.Array]:
        """Windows, documents and places of the contexts passed on; the anchor stands in front of each window."""
        if not self.open:
            return [pa.nulls(0, kind) for kind in list(self.kinds.values())[-3:]]
        keys, contexts, docs, places = zip(*self.open, strict=True)
        sizes = np.fromiter(map(len, contexts), np.int64, len(contexts))
        begins, data = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(contexts), np.uint8)
        times = np.fromiter(map(len, places), np.int64, len(places))
        copy = np.repeat(np.arange(len(sizes)), times)  # a context once for each of its places
        counts = (sizes - SPAN - 3)[copy]
        of = np.repeat(copy, counts)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
        windows = np.empty((len(of), 12 + SPAN), np.uint8)
        windows[:, :8] = np.array(keys, "<i8").view(np.uint8).reshape(-1, 8)[of]
        windows[:, 8:12] = data[begins[:, None] + np.arange(4)][of]
        windows[:, 12] = data[begins + 4][of] - nth
        windows[:, 13:] = np.lib.stride_tricks.sliding_window_view(data, SPAN - 1)[begins[of] + 5 + nth]
        ends = np.arange(len(of) + 1, dtype=np.int32) * windows.shape[1]
        place = np.repeat([place for own in places for place in own], counts) + nth
        values = pa.Array.from_buffers(pa.binary(), len(of), [None, pa.py_buffer(ends), pa.py_buffer(windows)])
        return [values, pa.array(np.array(docs, np.int64)[of]), pa.array(place.astype(np.int64))]

    def group(self, entries: list) -> None:
        """Contexts (context, document, places) of one anchor, all different."""
        if len(entries) > 1:
            self.block.append(entries)
            self.symbols += sum(len(context) - 3 for context, _, _ in entries)
            if self.symbols > BLOCK:
                self.solve()

    def pass_on(self, entry: list, key: int) -> None:
        """A context of an anchor with too many of them, as its windows."""
        context, doc, places = entry
        self.open.append((key, context, doc, places))
        self.windows += (len(context) - SPAN - 3) * len(places)

    def solve(self) -> None:
        """Sort the suffixes of the block; equal windows are neighbours then."""
        if not self.block:
            return
        entries = [entry for group in self.block for entry in group]
        group = np.repeat(np.arange(len(self.block)), [len(group) for group in self.block])
        self.block, self.symbols = [], 0
        left, right = _agreeing([context for context, _, _ in entries], group)
        rows = np.flatnonzero(left + right >= SPAN - 1)
        if not len(rows):
            return
        entries, group, left, right = [entries[k] for k in rows.tolist()], group[rows], left[rows], right[rows]
        sizes = left + right + 2  # with the anchor as one symbol, and an end
        begins = np.cumsum(sizes) - sizes
        pieces = []
        for (c, _, _), before, after in zip(entries, left.tolist(), right.tolist(), strict=True):
            at = 5 + c[4]
            pieces += (c[at - before : at], b"\0", c[at : at + after], b"\0")
        symbols = np.frombuffer(b"".join(pieces), np.uint8).astype(np.int64) + 1
        symbols[begins + left] = 257 + group
        symbols[begins + sizes - 1] = 0
        order = np.array(suffix_order(symbols.tolist()))
        owner = np.repeat(np.arange(len(entries)), sizes)
        order = order[order - begins[owner[order]] < (sizes - SPAN)[owner[order]]]
        owner = owner[order]
        windows = symbols.astype(np.uint32)[order[:, None] + np.arange(SPAN)]
        new = np.concatenate(([True], (windows[1:] != windows[:-1]).any(axis=1)))
        docs = np.array([doc for _, doc, _ in entries])[owner]
        least = np.minimum.reduceat(docs, np.flatnonzero(new))[np.cumsum(new) - 1]
        late = np.flatnonzero(docs > least)
        counts = np.array([len(places) for _, _, places in entries])
        times = counts[owner[late]]
        nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        late = np.repeat(late, times)
        places = np.array([place for _, _, places in entries for place in places])
        skipped = np.array([c[4] for c, _, _ in entries]) - left - begins
        place = places[(np.cumsum(counts) - counts)[owner[late]] + nth] + order[late] + skipped[owner[late]]
        self.cover(docs[late], place, np.ones(len(late), np.int64))


def _covered(contexts: DataFrame, chunks: int) -> DataFrame:
    """Windows to remove, as lists by chunk, or still to be compared by their bytes."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, entries, key, many = _Settled(chunks), [], None, False
        for batch in batches:
            keys, docs, places, windows = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 2, 3, 4))
            with_context = batch.column(1).is_valid().to_numpy(zero_copy_only=False)
            out.cover(docs[~with_context], places[~with_context], windows[~with_context])
            keys, docs, places, windows = (x[with_context] for x in (keys, docs, places, windows))
            contexts = batch.column(1).drop_null()
            if not len(contexts):
                continue
            unlike = pc.not_equal(contexts.slice(1), contexts.slice(0, len(contexts) - 1))
            new = np.concatenate(([True], (keys[1:] != keys[:-1]) | unlike.to_numpy(zero_copy_only=False)))
            last = entries[-1] if entries else None
            new[0] = last is None or keys[0] != key or contexts[0].as_py() != last[0]
            # copies of a context go if a smaller document has it; that is the first of them
            run, heads = np.cumsum(new), np.flatnonzero(new)
            least = np.concatenate(([docs[0] if last is None else last[1]], docs[heads]))[run]
            late = docs > least
            out.cover(docs[late], places[late], windows[late])
            again: dict[int, list[int]] = {}
            for k in np.flatnonzero(~new & ~late).tolist():
                again.setdefault(int(run[k]), []).append(int(places[k]))
            if last is not None:
                last[2].extend(again.get(0, ()))
            own = (keys[heads].tolist(), contexts.take(heads).to_pylist(), docs[heads].tolist(), places[heads].tolist())
            for number, (new_key, context, doc, place) in enumerate(zip(*own, strict=True), 1):
                if not entries or new_key != key or context[:4] != entries[-1][0][:4]:
                    if many:
                        out.pass_on(entries[-1], key)
                    else:
                        out.group(entries)
                    entries, key, many = [], new_key, False
                entries.append([context, doc, [place, *again.get(number, ())]])
                if many or len(entries) > MOST_CONTEXTS:
                    many = True
                    for entry in entries[:-1]:
                        out.pass_on(entry, key)
                    entries = entries[-1:]
            if out.rows + out.windows > 100_000:
                yield out.batch()
        if many:
            out.pass_on(entries[-1], key)
        else:
            out.group(entries)
        out.solve()
        yield out.batch()

    ordered = contexts.repartition("key").sortWithinPartitions("key", "context", "doc", "place")
    schema = "chunk long, docs binary, places binary, windows binary, window binary, doc long, place long"
    return ordered.mapInArrow(lean_stream(stream), schema)


def _settled(covered: DataFrame, chunks: int) -> DataFrame:
    """Lists by chunk of all windows to remove: the listed ones, and open ones whose bytes a smaller document has."""

    names = ("chunk", "docs", "places", "windows")
    lists = covered.filter("window IS NULL").select(*names)
    windows = covered.filter("window IS NOT NULL").select("window", "doc", "place")
    least = windows.groupBy("window").agg(F.min("doc").alias("least"))
    late = windows.join(least, "window").filter("doc > least").select("doc", "place")
    return lists.union(_as_lists(late, chunks, 1))


def _removed(docs: DataFrame, lists: DataFrame, as_text: bool) -> DataFrame:
    """Each document's counts with a digest of what is left, or what is left itself."""

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = left.column("doc_id").to_numpy()
        texts = [x or b"" for x in left.column("bytes").to_pylist()]
        variant = _variants(ids, texts)
        data, bounds = _buffer(left.column("bytes"))
        change = np.zeros(len(data) + 1, np.int32)
        whole: set[tuple[int, int]] = set()
        ranges = [np.zeros((3, 0), np.int64)]
        for lists in right.to_pylist():
            rows = np.stack([np.frombuffer(lists[x], np.int64) for x in ("docs", "places", "windows")])
            if rows.shape[1] and rows[2, 0] < 0:
                whole.update(zip(rows[0].tolist(), rows[1].view(np.uint64).tolist(), strict=True))
            else:
                ranges.append(rows)
        doc, place, windows = np.concatenate(ranges, axis=1)
        i, row = _joined(doc, ids)
        own = place[i] >> _PLACE_BITS == variant[row]
        i, row = i[own], row[own]
        begin = bounds[row] + (place[i] & ((1 << _PLACE_BITS) - 1))
        np.add.at(change, begin, np.int32(1))
        np.subtract.at(change, begin + windows[i] + LENGTH - 1, np.int32(1))
        copied = {doc for doc, _ in whole}
        for row, doc in enumerate(ids.tolist()):
            if doc in copied and (doc, text_hash(texts[row])) in whole:
                change[bounds[row]] += 1
                change[bounds[row + 1]] -= 1
        gone = np.cumsum(change, dtype=np.int32, out=change)[:-1] > 0
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        begins[bounds[:-1][bounds[:-1] < len(data)]] = gone[bounds[:-1][bounds[:-1] < len(data)]]

        def total(marks: np.ndarray) -> np.ndarray:
            # a chunk's bytes are fewer than 2^31, as Arrow's binary columns ask
            change[0] = 0
            np.cumsum(marks, dtype=np.int32, out=change[1:])
            return change[bounds].astype(np.int64)

        removed, spans = np.diff(total(gone)), np.diff(total(begins))
        left_over = data[~gone].tobytes()
        ends = total(~gone)
        kept = [left_over[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        out = left.drop_columns(["chunk", "bytes"])
        if as_text:
            null = np.array([x is None for x in left.column("bytes").to_pylist()], bool)
            cleaned = [None if no else part.decode(errors="ignore") for no, part in zip(null, kept, strict=True)]
            out = out.append_column("cleaned", pa.array(cleaned, pa.string()))
        else:
            out = out.append_column("n_bytes", pa.array(np.diff(bounds), pa.int64()))
        out = out.append_column("n_removed", pa.array(removed.astype(np.int64)))
        if as_text:
            return out
        out = out.append_column("n_spans", pa.array(spans.astype(np.int64)))
        return out.append_column("kept_sha256", pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()))

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name not in ("chunk", "bytes")]
    own = ["cleaned string", "n_removed long"] if as_text else ["n_bytes long", "n_removed long", "n_spans long", "kept_sha256 string"]
    return docs.groupBy("chunk").cogroup(lists.groupBy("chunk")).applyInArrow(lean(cut), ", ".join(fields + own))


def _prime(least: int) -> int:
    while any(least % k == 0 for k in range(2, int(least**0.5) + 1)):
        least += 1
    return max(least, 2)


def _cleaned(docs: DataFrame, as_text: bool) -> DataFrame:
    """``docs``: doc_id (not null), bytes and more."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    buckets = max(shuffle_partitions(spark), size // (16 * CHUNK_BYTES) + 1)
    chunks = _prime(max(shuffle_partitions(spark), size // CHUNK_BYTES + 1))
    chunked = docs.withColumn("chunk", F.pmod("doc_id", F.lit(chunks)).cast("long"))
    shared = stored(_shared(docs.select("doc_id", "bytes"), buckets, chunks), "shared")
    contexts = _contexts(chunked.select("chunk", "doc_id", "bytes"), shared)
    covered = stored(_covered(contexts, chunks), "covered")
    lists = _settled(covered, chunks).union(_copies(docs.select("doc_id", "bytes"), chunks))
    return _removed(chunked, lists, as_text)


def repeated_bytes(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of what is left of each text.

    A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a document with a smaller id. Reads doc_id
    and text alone. Null texts are empty. A null id is smaller than none and none is smaller: such rows stay whole.
    Rows that repeat an id are one document, whatever their texts, and lose nothing to each other. An empty table gives
    none.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).cast("binary").alias("bytes"))
    found = _cleaned(rows.filter("doc_id IS NOT NULL"), as_text=False)
    zero = F.lit(0).cast("long")
    unnamed = rows.filter("doc_id IS NULL").select(
        "doc_id", F.octet_length("bytes").cast("long").alias("n_bytes"), zero.alias("n_removed"),
        zero.alias("n_spans"), F.sha2("bytes", 256).alias("kept_sha256"),
    )
    return found.union(unnamed)


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents with those bytes removed, all columns kept; a text of which nothing is left goes altogether.

    A character that loses some of its bytes goes as a whole. Null texts stay null.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    text, doc_id = names[docs.columns.index("text")], docs.columns.index("doc_id")
    plain = docs.toDF(*names)
    kept = plain.select(
        *[c for c in names if c != text],
        F.col(names[doc_id]).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("bytes"),
    )
    found = _cleaned(kept.filter("doc_id IS NOT NULL"), as_text=True)
    found = found.filter("n_removed = 0 OR length(cleaned) > 0").withColumnRenamed("cleaned", text).select(*names)
    return found.union(plain.filter(F.col(names[doc_id]).isNull())).toDF(*docs.columns)

"""Repeated-passage removal: maximal repeats from an enhanced suffix array.

The corpus is cut so that equal passages meet in one task.  Every window of ``length`` bytes has
an anchor, the least of the hashes of the 37-byte strings in it (their number is ``ANCHORS``).
Consecutive windows with one place of their anchor form a slice of text, and slices are dealt out by
anchor: equal windows have equal anchors, so all suffixes that share ``length`` bytes are in one
task.  There a suffix array with its common-prefix table is built over the slices, and a stack
scan walks the tree of common-prefix intervals.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import tokens as T
from quarry.llm.common import drop_clashing

ANCHORS = 64                 # a power of two: sliding minima by doubling
LENGTH = 100
CHUNK = 6 << 20              # bytes of slices that one suffix array covers, at least one anchor
PIECE = 1 << 20
PLACE = np.uint64((1 << 24) - 1)     # low bits that hold a place within a piece
ADDED = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text")
NO_ID = (1 << 63) - 1        # a null doc_id comes after all others


def _runs(data: np.ndarray, length: int):
    """Windows of one text by the place of their anchor, the leftmost least hash in the window.

    Returns the first window of each run with the same anchor place, closed by the number of
    windows, and the anchor hash of each run.
    """
    k = length - ANCHORS + 1
    begin, anchors = [], []
    for lo in range(0, data.size - length + 1, PIECE):
        seg = data[lo: lo + PIECE + length - 1]
        power, inverse = T.POWERS.upto(seg.size + 1)
        total = np.zeros(seg.size + 1, dtype=np.uint64)
        np.cumsum(T.BYTE[seg] * power[: seg.size], out=total[1:])
        h = T.mix((total[k:] - total[:-k]) * inverse[: seg.size - k + 1])
        m = (h & ~PLACE) | np.arange(h.size, dtype=np.uint64)      # ties go to the leftmost
        step = 1
        while step < ANCHORS:
            m = np.minimum(m[:-step], m[step:])
            step *= 2
        at = np.flatnonzero(np.concatenate([[True], m[1:] != m[:-1]]))
        begin.append(at + lo)
        anchors.append(h[(m[at] & PLACE).astype(np.int64)])
    if not begin:
        return np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    return np.append(np.concatenate(begin), data.size - length + 1), np.concatenate(anchors)


def _rows(batch: pa.RecordBatch):
    data, offsets = T.buffers(batch.column("text"))
    for r, key in enumerate(batch.column("_key").to_pylist()):
        yield r, key, data[offsets[r]: offsets[r + 1]]


def _anchor_rows(length: int):
    """Anchors of each document: one row per run of windows."""
    def run(batches):
        for batch in batches:
            keys, anchors, size = [], [], 0
            for _, key, data in _rows(batch):
                _, a = _runs(data, length)
                anchors.append(a)
                keys.append(np.full(a.size, key, dtype=np.int64))
                size += a.size
                if size > 200_000:
                    yield _pair(keys, anchors)
                    keys, anchors, size = [], [], 0
            if size:
                yield _pair(keys, anchors)
    return run


def _pair(keys, anchors):
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(anchors).view(np.int64))],
                                      names=["_key", "anchor"])


_SLICE = "anchor long, _key long, _tid long, start long, windows long, bytes binary"


def _slice_rows(length: int, collapse: bool):
    """The slices of each document whose anchors occur elsewhere too.

    With ``collapse``, a slice whose bytes were met in the batch at an earlier place is sent
    without its bytes: all its windows are repeats, and one copy stands for all in the array.
    """
    def run(batches):
        for batch in batches:
            found = {name: [] for name in _FOUND}
            best: dict[bytes, int] = {}
            data, offsets = T.buffers(batch.column("text"))
            shared = batch.column("_shared")
            tids = batch.column("_tid").to_pylist()
            for r, key in enumerate(batch.column("_key").to_pylist()):
                text = data[offsets[r]: offsets[r + 1]]
                begin, a = _runs(text, length)
                known = shared[r].values.to_numpy(zero_copy_only=False).view(np.uint64)
                at = np.flatnonzero(np.isin(a, known))
                whole, tid = text.tobytes() if at.size else b"", tids[r]
                for anchor, lo, hi in zip(a[at].view(np.int64).tolist(), begin[at].tolist(), begin[at + 1].tolist()):
                    body = whole[lo: hi + length - 1]
                    if collapse:
                        _keep_first(best, found, body, (key, tid, lo), len(found["start"]))
                        if best[body] != len(found["start"]):
                            body = None
                    for name, value in zip(_FOUND, (anchor, key, tid, lo, hi - lo, body)):
                        found[name].append(value)
                if len(found["start"]) > 50_000:
                    yield _slices(found)
                    found, best = {name: [] for name in _FOUND}, {}
            if found["start"]:
                yield _slices(found)
    return run


_FOUND = ("anchor", "_key", "_tid", "start", "windows", "bytes")


def _keep_first(best: dict, rows: dict, body: bytes, place: tuple, row: int):
    """``best[body]`` is the row of the earliest place of ``body``; a later row loses its bytes."""
    other = best.get(body)
    if other is None:
        best[body] = row
    elif place < (rows["_key"][other], rows["_tid"][other], rows["start"][other]):
        rows["bytes"][other] = None
        best[body] = row


def _slices(found):
    return pa.RecordBatch.from_arrays(
        [pa.array(v, pa.binary() if n == "bytes" else pa.int64()) for n, v in found.items()], names=list(found))


def suffix_array(text: np.ndarray, at: np.ndarray, end: np.ndarray):
    """Order of the suffixes that begin ``at`` and stop before ``end``, and their common prefixes.

    Positions are ordered by their first 7 bytes, then by doubling; a position past its end
    sorts before every byte.  lcp[i] is the common prefix of the i-th and the one before it.
    """
    n = text.size
    # per position: bytes until its slice ends
    room = np.repeat(end, np.diff(end, prepend=0)) - np.arange(n)
    code = np.zeros(n, dtype=np.uint64)
    padded = np.zeros(n + 7, dtype=np.uint64)
    padded[:n] = text
    padded[:n] += np.uint64(1)
    for d in range(7):
        code <<= np.uint64(9)
        code += padded[d: d + n] * (room > d)
    rank = _ranks(code)
    step, ranks, longest = 7, [(7, rank)], int(room.max(initial=0))
    while step < longest:
        code = rank * np.uint64(n + 2)
        code[: n - step] += (rank[step:] + np.uint64(1)) * (room[: n - step] > step)
        rank = _ranks(code)
        step *= 2
        ranks.append((step, rank))
    order = np.argsort(rank[at] * np.uint64(at.size + 1) + np.arange(at.size, dtype=np.uint64))     # ties by place
    sa = at[order]
    # common prefix of neighbours: descend from the longest level at which ranks agree, then by byte
    a, b = sa[:-1].copy(), sa[1:].copy()
    lcp = np.zeros(a.size, dtype=np.int64)
    most = np.minimum(room[sa[:-1]], room[sa[1:]]) if a.size else lcp
    for width, r in reversed(ranks):
        for _ in range(2 if width == 7 else 1):
            go = np.flatnonzero(lcp + width <= most)
            go = go[r[a[go]] == r[b[go]]]
            lcp[go] += width
            deeper = go[lcp[go] < most[go]]
            a[deeper] += width
            b[deeper] += width
    for _ in range(7):
        go = np.flatnonzero(lcp < most)
        go = go[text[a[go]] == text[b[go]]]
        lcp[go] += 1
        deeper = go[lcp[go] < most[go]]
        a[deeper] += 1
        b[deeper] += 1
    return order, np.concatenate([[0], lcp])


def _ranks(code: np.ndarray) -> np.ndarray:
    order = np.argsort(code)                # equal codes share a rank, so their order is free
    new = np.ones(code.size, dtype=bool)
    code = code[order]
    new[1:] = code[1:] != code[:-1]
    out = np.empty(code.size, dtype=np.uint64)
    out[order] = np.cumsum(new).astype(np.uint64) - np.uint64(1)
    return out


def maximal_repeats(lcp: np.ndarray, left: np.ndarray, least: int):
    """Stack scan of the common-prefix interval tree, for depths of at least ``least``.

    ``left`` holds the byte before each suffix in suffix-array order; a negative value differs
    from every byte.  Yields (depth, from, to, children), children first: the suffixes from..to
    are all occurrences of one repeat, and are not all preceded by the same byte.  ``children``
    are the parts that meet in the interval, each a (from, to).  Intervals without such
    left-diversity come with depth 0: each of their occurrences continues one of a repeat that is
    longer by a byte to the left.
    """
    differs = np.ones(left.size, dtype=np.int64)
    differs[1:] = (left[1:] != left[:-1]) | (left[1:] < 0)
    changes = np.concatenate([[0], np.cumsum(differs)]).tolist()

    def closed(depth, begin, to, children):
        return depth if changes[to + 1] - changes[begin + 1] else 0, begin, to, children

    deep = np.flatnonzero(lcp >= least)
    if not deep.size:
        return
    for block in np.split(deep, np.flatnonzero(np.diff(deep) > 1) + 1):
        depths = lcp[block[0]: block[-1] + 1].tolist()
        stack: list[tuple[int, int, list]] = []
        part = (int(block[0]) - 1, int(block[0]) - 1)        # the finished part to the left
        for i, d in enumerate(depths, int(block[0])):
            while stack and stack[-1][0] > d:
                depth, begin, children = stack.pop()
                children.append(part)
                yield closed(depth, begin, i - 1, children)
                part = (begin, i - 1)
            if stack and stack[-1][0] == d:
                stack[-1][2].append(part)
            else:
                stack.append((d, part[0], [part]))
            part = (i, i)
        to = int(block[-1])
        while stack:
            depth, begin, children = stack.pop()
            children.append(part)
            yield closed(depth, begin, to, children)
            part = (begin, to)


def later_occurrences(lcp: np.ndarray, left: np.ndarray, place: np.ndarray, least: int):
    """For each suffix its longest repeat that has an earlier occurrence: (suffixes, depths).

    Going up the tree, the earliest occurrence of each child moves on, and all but the earliest of
    them end there: every suffix ends once, so the work is that of the scan however deep the
    intervals nest.  Pairs, the commonest case, are done at once.
    """
    ok = np.concatenate([lcp >= least, [False]])
    alone = np.flatnonzero(ok[:-1] & ~ok[1:] & ~np.concatenate([[False], ok[:-2]]))
    diverse = alone[(left[alone] != left[alone - 1]) | (left[alone] < 0)]
    who = [np.where(place[diverse] > place[diverse - 1], diverse, diverse - 1)]
    depth = [lcp[diverse]]
    rest = lcp.copy()
    rest[alone] = 0
    first: dict[tuple[int, int], int] = {}
    spot = place.tolist()
    some, deep = [], []
    for d, begin, to, children in maximal_repeats(rest, left, least):
        firsts = [c[0] if c[0] == c[1] else first.pop(c) for c in children]
        least_one = min(firsts, key=spot.__getitem__)
        first[(begin, to)] = least_one
        if d:
            some += [x for x in firsts if x != least_one]
            deep += [d] * (len(firsts) - 1)
    return (np.concatenate([*who, np.array(some, dtype=np.int64)]), np.concatenate([*depth, np.array(deep, dtype=np.int64)]))


def _joined_spans(begin: np.ndarray, end: np.ndarray):
    """Union of spans as (begin, end) of its maximal runs."""
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], begin[1:] > end[:-1]])
    at = np.flatnonzero(new)
    return begin[at], end[np.append(at[1:], begin.size) - 1]


_SPAN = "_key long, _tid long, begin long, end long"
_OCCURRENCE = "repeat string, n_bytes long, _key long, _tid long, start long"


def _chunks(batches):
    """Rows sorted by anchor, in lists of whole anchors of about CHUNK bytes."""
    rows, size, last = {name: [] for name in _FOUND}, 0, None
    for batch in batches:
        columns = {n: batch.column(n).to_pylist() if n == "bytes" else batch.column(n).to_numpy().tolist() for n in _FOUND}
        done = 0
        for i, (anchor, body) in enumerate(zip(columns["anchor"], columns["bytes"])):
            if size > CHUNK and anchor != last:
                for name in _FOUND:
                    rows[name] += columns[name][done:i]
                yield rows
                rows, size, done = {name: [] for name in _FOUND}, 0, i
            last = anchor
            size += len(body or b"")
        for name in _FOUND:
            rows[name] += columns[name][done:]
    if rows["anchor"]:
        yield rows


def _enhanced(rows: dict, picked: list, length: int):
    """Suffix array over the slices in ``picked``: per suffix, in order, its row, its offset in
    the slice, the byte before it, and the common-prefix table."""
    bodies = [np.frombuffer(rows["bytes"][i], dtype=np.uint8) for i in picked]
    text = np.concatenate(bodies)
    end = np.cumsum([b.size for b in bodies])
    windows = np.array([rows["windows"][i] for i in picked])
    own = np.repeat(np.arange(len(picked)), windows)
    offset = np.arange(own.size) - np.repeat(np.cumsum(windows) - windows, windows)
    at = (end - [b.size for b in bodies])[own] + offset
    order, lcp = suffix_array(text, at, end)
    own, offset, at = own[order], offset[order], at[order]
    left = np.where(offset > 0, text[at - 1].astype(np.int64), -1)
    return np.array(picked)[own], offset, left, lcp


def _span_rows(length: int):
    """Spans that also occur earlier, from all slices of a partition's anchors."""
    def run(batches):
        for rows in _chunks(batches):
            key, tid, start, windows = (np.array(rows[n], dtype=np.int64) for n in ("_key", "_tid", "start", "windows"))
            best: dict[bytes, int] = {}
            for i, body in enumerate(rows["bytes"]):
                if body is not None:
                    if (rows["_key"][i], rows["_tid"][i], rows["start"][i]) == _place(rows, best.get(body)):
                        continue                      # the same document twice
                    _keep_first(best, rows, body, (rows["_key"][i], rows["_tid"][i], rows["start"][i]), i)
            stands = np.zeros(key.size, dtype=bool)
            stands[list(best.values())] = True
            mine = {_place(rows, i) for i in best.values()}
            copies = np.array([i for i in np.flatnonzero(~stands) if _place(rows, i) not in mine], dtype=np.int64)
            who, begin, end = [copies], [start[copies]], [start[copies] + windows[copies] + length - 1]
            # an anchor with one distinct slice left has nothing more to compare
            several = {a for a, n in _counts(rows["anchor"][i] for i in best.values()) if n > 1}
            picked = [i for i in best.values() if rows["anchor"][i] in several]
            if picked:
                row, offset, left, lcp = _enhanced(rows, picked, length)
                doc = np.unique(np.stack([key, tid], axis=1), axis=0, return_inverse=True)[1].ravel()
                at = start[row] + offset
                order = np.lexsort((at, doc[row]))
                place = np.empty(order.size, dtype=np.int64)
                place[order] = np.arange(order.size)
                suffix, depth = later_occurrences(lcp, left, place, length)
                who.append(row[suffix])
                begin.append(at[suffix])
                end.append(at[suffix] + depth)
            who, begin, end = np.concatenate(who), np.concatenate(begin), np.concatenate(end)
            if not who.size:
                continue
            # union within each slice, slices set apart on one line
            far = int(end.max()) + 1
            b, e = _joined_spans(who * far + begin, who * far + end)
            row, b = np.divmod(b, far)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[row]), pa.array(tid[row]), pa.array(b), pa.array(e - row * far)], names=["_key", "_tid", "begin", "end"])
    return run


def _place(rows, i):
    return None if i is None else (rows["_key"][i], rows["_tid"][i], rows["start"][i])


def _counts(values):
    found: dict = {}
    for v in values:
        found[v] = found.get(v, 0) + 1
    return found.items()


def _group_rows(length: int):
    """All occurrences of every maximal repeat, a row each."""
    def run(batches):
        for rows in _chunks(batches):
            row, offset, left, lcp = _enhanced(rows, list(range(len(rows["anchor"]))), length)
            for depth, begin, to, _ in maximal_repeats(lcp, left, length):
                if depth:
                    lead = row[begin]
                    body = rows["bytes"][lead][offset[begin]: offset[begin] + depth]
                    name = hashlib.md5(body).hexdigest()
                    some = row[begin: to + 1]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * some.size), pa.array(np.full(some.size, depth, dtype=np.int64)),
                         pa.array([rows["_key"][i] for i in some]), pa.array([rows["_tid"][i] for i in some]),
                         pa.array([rows["start"][i] + int(o) for i, o in zip(some, offset[begin: to + 1])])],
                        names=["repeat", "n_bytes", "_key", "_tid", "start"])
    return run


def _keyed(docs: DataFrame) -> DataFrame:
    return drop_clashing(docs, *ADDED, "_key", "_tid", "_shared", "_spans").withColumns({
        "_key": F.coalesce(F.col("doc_id"), F.lit(NO_ID)), "_tid": F.xxhash64(F.coalesce(F.col("text"), F.lit("")))})


def _dealt(docs: DataFrame, length: int, collapse: bool) -> DataFrame:
    """Slices with shared anchors, dealt out and sorted by anchor."""
    # grouping and join read the same exchange: same columns, same filter on both branches
    anchors = (docs.select("_key", "text").mapInArrow(_anchor_rows(length), "_key long, anchor long")
               .where("anchor is not null and _key is not null").repartition("anchor"))
    again = (anchors.groupBy("anchor").agg(F.count("*").alias("n"), F.max("_key").alias("last"))
             .where("n > 1 and last is not null").select("anchor"))
    shared = (anchors.join(again.hint("shuffle_hash"), "anchor").groupBy("_key")
              .agg(F.collect_set("anchor").alias("_shared")))
    return (docs.join(shared, "_key").mapInArrow(_slice_rows(length, collapse), _SLICE)
            .repartition("anchor").sortWithinPartitions("anchor"))


def repeat_groups(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Every maximal repeat of at least ``length`` bytes with all its occurrences.

    Rows: repeat (name of its bytes), n_bytes, doc_id, start (byte).  A repeat is right-maximal
    within its slice and left-diverse; a passage longer than a slice appears as its overlapping
    pieces.  The rows are as many as there are occurrences, so nested repeats are listed for each.
    """
    return (_dealt(_keyed(docs.select("doc_id", "text")).distinct(), length, False).mapInArrow(_group_rows(length), _OCCURRENCE)
            .select("repeat", "n_bytes", F.when(F.col("_key") != NO_ID, F.col("_key")).alias("doc_id"), "start"))


def _rest(names: list, with_text: bool):
    """Texts without their spans: counts, digest, and with ``with_text`` the bytes that stay."""
    def run(batches):
        for batch in batches:
            data, offsets = T.buffers(batch.column("text"))
            spans, tids = batch.column("_spans"), batch.column("_tid").to_pylist()
            cols = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "kept_text": []}
            for r in range(batch.num_rows):
                text = data[offsets[r]: offsets[r + 1]]
                own = [s for s in spans[r].as_py() or () if s["_tid"] == tids[r]]
                keep = np.ones(text.size, dtype=bool)
                n = 0
                if own:
                    b, e = _joined_spans(np.array([s["begin"] for s in own]), np.array([s["end"] for s in own]))
                    n = b.size
                    for x, y in zip(b, e):
                        keep[x:y] = False
                left = text[keep].tobytes() if n else text.tobytes()
                for name, value in zip(cols, (text.size, text.size - len(left), n, hashlib.sha256(left).hexdigest(), left if with_text else None)):
                    cols[name].append(value)
            added = [pa.array(cols[n], pa.int64()) for n in ("n_bytes", "n_removed", "n_spans")] + [pa.array(cols["kept_sha256"])]
            if with_text:
                added.append(pa.array(cols["kept_text"], pa.binary()))
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + added, names=names + list(ADDED[: len(added)]))
    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, with_text: bool = False) -> DataFrame:
    """Every row of ``docs`` with n_bytes, n_removed, n_spans and kept_sha256 of its UTF-8 text
    without each byte that a ``length``-byte string covers which also starts earlier (smaller
    doc_id, or the same document at an earlier byte).  ``with_text`` adds kept_text (binary).

    Null texts count as empty; texts shorter than ``length`` bytes lose nothing.  A null doc_id
    comes after all others.  Rows that share a doc_id are ordered by a hash of their text; rows
    equal in doc_id and text are one document, and each gets its result.  An empty table gives no
    rows.  Columns named like the added ones are replaced; all others are kept.

    Documents are shuffled by doc_id once for both joins (the exchange is the same plan and is
    reused).  Copies of a slice are collapsed before the shuffle by anchor, batch by batch, and
    again before an array is built, so a large group of copies costs one slice per batch.
    """
    keyed = _keyed(docs)
    spans = (_dealt(keyed, length, True).mapInArrow(_span_rows(length), _SPAN)
             .groupBy("_key").agg(F.collect_list(F.struct("_tid", "begin", "end")).alias("_spans")))
    names = [c for c in keyed.columns if not c.startswith("_")]
    fields = [f for f in keyed.schema.fields if f.name in names]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    added = "n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept_text binary" * with_text
    return keyed.join(spans, "_key", "left").mapInArrow(_rest(names, with_text), f"{schema}, {added}")


def op10_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    from quarry.llm.common import table
    return remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")

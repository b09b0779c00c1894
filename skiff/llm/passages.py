"""Near-duplicate passages with compact windows.

A text is its sequence of five-word shingles. For each of HASHES hash functions a Cartesian
tree over the shingles' hash values yields compact windows (l, c, r): all subsequences that
start in [l, c] and end in [c, r] share the minimum at c. Only windows of LEAST shingles (50 words)
or more are kept, some 2 n / LEAST of them, made for all texts of a block level by level of the trees.

Windows of one function with equal minima collide. ``shared_keys`` drops minima that no other
document has; every other window is joined first to the document with the smallest id that has the minimum (so a
passage in a third of all rows gives one link a row, not all pairs). The interval join of a
document's collisions with one source counts how many functions cover each shingle; runs
covered by ENOUGH of HASHES functions are candidates. A pair at similarity 0.8 that only two documents hold is
missed by a probability of 0.002. Only candidates ask: the source's shingles come to their block, once for all documents of
the block, and verify them exactly: a passage is a maximal union of 50-word windows that share at least
8/9 of their shingles with the source (a similarity of 0.8 between passages of one size).

Where a window's first link is not confirmed around its minimum, all windows with that minimum meet again with
the shingles around it. Two of them are compared unless confirmed links around this minimum already connect them:
a window can only be similar to another if 8/9 of LEAST successive shingles occur in others too, and two similar
windows share one of their rarest shingles (prefix filter), so texts that share nothing but a frequent line cost no
pairs, and nothing is left out. One function is enough for such a link; the exact check is the same.

Result: one row per passage: doc_id, source_id (smaller), start_word, end_word (exclusive), shared (matching
shingles). Null or short texts give none; repeated ids are no sources of each other; rows
without an id are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from skiff.llm.blocks import block_table, block_texts, is_shared, pack, planes, ranges, run_folder, shared_keys, short, unpack, unplanes, written
from skiff.llm.common import mix64, shingles, words

WORDS, LEAST = 5, 46
HASHES, ENOUGH = 6, 2
SHARE = 8 / 9
_PIECE = 1 << 17
_LOW, _SCRAMBLE = np.uint64(0xFFFFFFFF), np.uint64(0x9E3779B1)
_UNSCRAMBLE = np.uint64(pow(0x9E3779B1, -1, 1 << 32))
# bytes of packed columns: (text, l, r, function, c) of a window; a link's place in its range, window, source, the
# source's block, l and r; minimum, block, place, done, text, l, r, c; range, place, window, source; done, text, l, r, c
_WINDOW = (4, 4, 4, 1, 4)
_LINK = (4, *_WINDOW, 8, 8, 4, 4)
_MEMBER = (4, 8, 4, 1, 4, 4, 4, 4)
_CANDIDATE = (8, 4, *_WINDOW, 8)
_PENDING = (1, 4, 4, 4, 4)


def compact_windows(values: np.ndarray, first: np.ndarray, least: int = LEAST, period: int = 1 << 32):
    """(l, c, r) of the compact windows of at least ``least`` values; ``first`` bounds the texts. Places count
    anew every ``period`` values, where the next function's begin."""
    lo, hi = first[:-1], first[1:]
    out = []
    # equal values (repeated shingles) are told apart by a scrambled position: trees stay shallow
    place = np.arange(len(values), dtype=np.uint64) % np.uint64(max(period, 1)) * _SCRAMBLE & _LOW
    packed = values & ~_LOW | place
    while True:
        ok = hi - lo >= least
        lo, hi = lo[ok], hi[ok]
        if not len(lo):
            break
        if len(packed) == hi[-1]:  # reduceat needs ends inside the array
            packed = np.append(packed, np.uint64(0xFFFFFFFFFFFFFFFF))
        cuts = _alternating(lo, hi)
        c = (np.minimum.reduceat(packed, cuts)[::2] * _UNSCRAMBLE & _LOW).astype(np.int64) + lo // period * period
        out.append((lo, c, hi - 1))
        lo, hi = _alternating(lo, c + 1), _alternating(c, hi)
    if not out:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*out))


def _alternating(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    out = np.empty(2 * len(x), x.dtype)
    out[::2], out[1::2] = x, y
    return out


def block_windows(raw: np.ndarray, off: np.ndarray):
    """(key, text, l, r, function, c) of a block's windows, places counted inside each text; a few texts
    at a time, so that the arrays stay in cache."""
    parts, k = [], 0
    while k < len(off) - 1:
        end = max(k + 1, int(np.searchsorted(off, off[k] + _PIECE, "right")) - 1)
        h, _, _, first = words(raw[off[k] : off[end]], off[k : end + 1] - off[k])
        s, sf = shingles(h, first, WORDS)
        n = max(len(s), 1)
        v = mix64(np.concatenate([s + np.uint64((j + 1) * 0x9E3779B97F4A7C15 % (1 << 64)) for j in range(HASHES)]))
        l, c, r = compact_windows(v, np.concatenate([*(sf[:-1] + j * len(s) for j in range(HASHES)), [HASHES * len(s)]]), period=n)
        j, key = c // n, v[c]
        row = np.searchsorted(sf, c - j * n, "right") - 1
        start = sf[row] + j * n
        parts.append((mix64(key + j.astype(np.uint64)), row + k, l - start, r - start, j, c - start))
        k = end
    if not parts:
        return (np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 5)
    return tuple(np.concatenate(x) for x in zip(*parts))


def _shared_windows(raw, off, bits, buckets, flags):
    """The block's windows with shared minima, in sending order."""
    key, row, l, r, f, c = block_windows(raw, off)
    hit = is_shared(key, bits, buckets, flags)
    key, row, l, r, f, c = (x[hit] for x in (key, row, l, r, f, c))
    cut = short(key, bits)
    order = np.lexsort((l, row, cut))
    return tuple(x[order] for x in (cut, row, l, r, f, c))


def similar_links(group: np.ndarray, doc: np.ndarray, joined: np.ndarray, size: np.ndarray, marks: np.ndarray):
    """(later, earlier) windows of one minimum whose surroundings are similar, as few as connect all that are.

    ``marks``: the shingles around each window's minimum, ``size`` of them a window; ``joined`` windows of
    a group are connected already."""
    need = int(np.ceil(SHARE * LEAST - 1e-9))
    of = np.repeat(np.arange(len(size)), size)
    marks = marks.astype(np.uint64)
    # a shingle that no other window of the group has is no hit; counted by hash first: too many may stay
    rough = mix64(marks | group[of].astype(np.uint64) << np.uint64(24)) >> np.uint64(64 - max(16, int(len(of)).bit_length() + 1))
    alive = _hopeful(rough.astype(np.int64), of, group, joined, need)
    on = alive[of]
    of = of[on]
    _, code = np.unique(marks[on] | group[of].astype(np.uint64) << np.uint64(24), return_inverse=True)
    while len(of):
        left = _hopeful(code, of, group, joined, need)
        on = left[of]
        if on.all():
            break
        of, code = of[on], code[on]
    if not len(of):
        return []
    often = np.bincount(code)[code]
    rarest = code[np.lexsort((code, often, of))]
    cuts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1], [True]]))
    place = dict(zip(of[cuts[:-1]].tolist(), zip(cuts[:-1].tolist(), cuts[1:].tolist())))
    alive = of[cuts[:-1]]
    boss = list(range(len(size)))

    def find(i):
        while boss[i] != i:
            boss[i] = boss[boss[i]]
            i = boss[i]
        return i

    star: dict[int, int] = {}
    for i in np.flatnonzero(joined).tolist():
        boss[i] = star.setdefault(int(group[i]), i)
    out, lists, copies, docs = [], {}, {}, doc.tolist()
    for i in alive[np.lexsort((doc[alive], group[alive]))].tolist():
        a, e = place[i]
        prefix = dict.fromkeys(rarest[a : e - need + 1].tolist())
        own = values = None
        tested = set()
        me = find(i)
        for x in prefix:
            classes = lists.get(x)
            if not classes or len(classes) == 1 and me in classes:
                continue
            for root in list(classes):
                members = classes.pop(root)
                now = find(root)
                for j in members if now != me else ():
                    if j in tested or docs[j] == docs[i]:
                        continue
                    tested.add(j)
                    if own is None:
                        own = code[a:e].tolist()
                        values = set(own)
                    y, z = place[j]
                    both = values.intersection(code[y:z].tolist())
                    if len(both) + len(own) - len(values) < need:
                        continue
                    sums = np.concatenate([[0], np.cumsum([v in both for v in own])])
                    if (sums[LEAST:] - sums[:-LEAST] >= need).any():
                        out.append((i, j))
                        boss[me] = now = me = find(j)
                        break
                now = find(now)
                classes[now] = classes[now] + members if now in classes else members
        # windows of two documents stand for all of their class with the same surroundings
        same = copies.setdefault(code[a:e].tobytes(), {})
        if any(find(j) == me and docs[j] != docs[k] and find(k) == me for j, k in same.values()):
            continue
        first, last = same.get(me, (i, i))
        same[me] = (first, i)
        for x in prefix:
            lists.setdefault(x, {}).setdefault(me, []).append(i)
    return out


def _hopeful(code: np.ndarray, of: np.ndarray, group: np.ndarray, joined: np.ndarray, need: int) -> np.ndarray:
    """Windows of which LEAST successive shingles hold ``need`` that other windows have, in groups where such a
    window is not joined yet. ``code``: shingles that are numbered inside each group, ``of``: their windows."""
    sums = np.concatenate([[0], np.cumsum((np.bincount(code) > 1)[code])])
    start = np.arange(max(len(of) - LEAST + 1, 0))
    good = (of[start] == of[start + LEAST - 1]) & (sums[start + LEAST] - sums[start] >= need)
    some = np.zeros(len(group), bool)
    some[of[start[good]]] = True
    return some & np.isin(group, group[some & ~joined])


def passages(docs: DataFrame) -> DataFrame:
    """(doc_id, source_id, start_word, end_word, shared) for ``docs`` (doc_id, text)."""
    folder = run_folder(docs, "passages")
    table, bits = block_table(docs.where("doc_id is not null"), folder)

    def keys_of(raw, off):
        key, row, *_ = block_windows(raw, off)
        return key, row

    flags = written(shared_keys(table, keys_of, bits), folder, "flags")
    # 1. windows meet the smallest document that has their minimum
    def collide(block, left, right):
        out = []
        if left.num_rows:
            ids, raw, off = block_texts(left)
            cut, *windows = _shared_windows(raw, off, bits, right["bucket"].to_pylist(), right["flags"].to_pylist())
            for b, a, e in ranges(cut, bits):
                mine = [x[a:e] for x in windows]
                out.append((b, block[0].as_py(), pack(cut[a:e]), planes(ids[mine[0]]), _packed(_WINDOW, *mine)))
        return _table(out, [("bucket", pa.int64()), ("block", pa.int64()), *((n, pa.binary()) for n in ("keys", "ids", "windows"))])

    def link(bucket, group):
        blocks = group["block"].to_pylist()
        keys = [unpack(x) for x in group["keys"].to_pylist()]
        size = [len(x) for x in keys]
        block = np.repeat(np.array(blocks), size)
        within = np.arange(len(block)) - np.repeat(np.cumsum([0, *size[:-1]]), size)
        doc = np.concatenate([unplanes(x) for x in group["ids"].to_pylist()]).view(np.int64)
        row, l, r, f, c = _unpacked(_WINDOW, group["windows"].to_pylist())
        _, at = np.unique(np.concatenate(keys), return_inverse=True)
        order = np.lexsort((l, doc, at))
        head = order[np.flatnonzero(np.concatenate([[True], at[order][1:] != at[order][:-1]]))]
        s = head[at]
        later = doc[s] < doc
        out, a = [], 0
        for b, n in zip(blocks, size):
            i = a + np.flatnonzero(later[a : a + n])
            if len(i):
                out.append((b, 1, bucket[0].as_py(), _packed(_LINK, within[i], row[i], l[i], r[i], f[i], c[i], doc[s[i]], block[s[i]], l[s[i]], r[s[i]])))
            a += n
        # windows of minima that more than two documents have
        docs_of = np.bincount(at[order][np.concatenate([[True], (at[order][1:] != at[order][:-1]) | (doc[order][1:] != doc[order][:-1])])])
        i = np.flatnonzero(docs_of[at] > 2)
        if len(i):
            out.append((None, 3, bucket[0].as_py(), _packed(_MEMBER, at[i], block[i], within[i], ~later[i], row[i], l[i], r[i], c[i])))
        return _table(out, [("block", pa.int64()), ("kind", pa.int32()), ("number", pa.int64()), ("windows", pa.binary())])

    sent = table.groupBy("block").cogroup(flags.groupBy("block")).applyInArrow(
        collide, "bucket long, block long, keys binary, ids binary, windows binary")
    links = written(sent.groupBy("bucket").applyInArrow(link, "block long, kind int, number long, windows binary"), folder, "links")

    # 2. the interval join of a document's collisions with each source: candidates ask for the source's shingles
    def ask(block, group):
        windows = group["windows"].to_pylist()
        within, row, l, r, f, c, source, home, low, high = _unpacked(_LINK, windows)
        bucket = np.repeat(np.array(group["number"].to_pylist(), np.int64), [len(x) // sum(_LINK) for x in windows])
        keep = candidates(row, source, f, l, r)
        hit = np.isin(source, source[keep])
        b = block[0].as_py()
        out = [(*x, None) for x in _asks(home[hit], np.full(hit.sum(), b), source[hit], low[hit], high[hit])]
        if keep.any():
            out.append((b, 1, *(None,) * 4, _packed(_CANDIDATE, *(x[keep] for x in (bucket, within, row, l, r, f, c, source)))))
        return _table(out, [("block", pa.int64()), ("kind", pa.int32()), ("number", pa.int64()),
                            *((n, pa.binary()) for n in ("sources", "to", "bounds", "windows"))])

    asks = written(links.where("kind = 1").groupBy("block").applyInArrow(
        ask, "block long, kind int, number long, sources binary, to binary, bounds binary, windows binary"), folder, "asks")

    # sources lend their shingles, once to each block that asks
    def lend(block, left, right):
        out = []
        if left.num_rows and right.num_rows:
            ids, raw, off = block_texts(left)
            wanted: dict[tuple[int, int], list[int]] = {}
            for sources, target, bounds in zip(*(right[n].to_pylist() for n in ("sources", "to", "bounds"))):
                low, high = np.frombuffer(bounds, "<u4").reshape(2, -1).tolist()
                for i, to, x, y in zip(unplanes(sources).view(np.int64).tolist(), unplanes(target).view(np.int64).tolist(), low, high):
                    have = wanted.setdefault((to, i), [x, y])
                    have[0], have[1] = min(have[0], x), max(have[1], y)
            s = _shingles_of(raw, off, np.flatnonzero(np.isin(ids, [i for _, i in wanted])))
            for (to, i), (x, y) in wanted.items():
                for k in range(int(np.searchsorted(ids, i)), int(np.searchsorted(ids, i, "right"))):
                    # 40 bits of a shingle tell a passage's shingles apart
                    out.append((to, i, planes(np.unique(s[k][x : y + 1] >> np.uint64(24)), 5)))
        return _table(out, [("block", pa.int64()), ("source", pa.int64()), ("lent", pa.binary())])

    lent = written(table.groupBy("block").cogroup(asks.where("kind = 2").groupBy("block")).applyInArrow(
        lend, "block long, source long, lent binary"), folder, "lent")

    # 3. the exact check
    def verify(block, left, right):
        out = []
        if left.num_rows and right.num_rows:
            ids, raw, off = block_texts(left)
            lent_by: dict[int, list[np.ndarray]] = {}
            for i, x in zip(right["source"].to_pylist(), right["lent"].to_pylist()):
                if x is not None:
                    lent_by.setdefault(i, []).append(unplanes(x, 5))
            known = {i: np.unique(np.concatenate(x)) for i, x in lent_by.items()}
            bucket, within, row, l, r, f, c, source = _unpacked(_CANDIDATE, [x for x in right["windows"].to_pylist() if x is not None])
            order = np.lexsort((source, row))
            bucket, within, row, l, r, f, c, source = (x[order] for x in (bucket, within, row, l, r, f, c, source))
            s = _shingles_of(raw, off, np.unique(row))
            joined = np.zeros(len(row), bool)
            start = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (source[1:] != source[:-1])])) if len(row) else []
            for a, e in zip(start, [*start[1:], len(row)]):
                k = int(row[a])
                for p in _verified(s[k] >> np.uint64(24), f[a:e], l[a:e], r[a:e], known.get(int(source[a]))):
                    out.append((block[0].as_py(), k, int(source[a]), *p, None, None))
                    joined[a:e] |= (c[a:e] >= p[0]) & (c[a:e] < p[1] - WORDS + 1)
            at = np.flatnonzero(joined)
            at = at[np.argsort(bucket[at], kind="stable")]
            cut = np.flatnonzero(np.concatenate([[True], bucket[at][1:] != bucket[at][:-1]])) if len(at) else []
            out += [(block[0].as_py(), *(None,) * 5, int(bucket[at[a]]), planes(within[at[a:e]], 4)) for a, e in zip(cut, [*cut[1:], len(at)])]
        return _table(out, [*((n, pa.int64()) for n in ("block", "place", "source_id", "start_word", "end_word", "shared", "bucket")), ("joined", pa.binary())])

    none = "cast(null as binary)"
    given = asks.where("kind = 1").selectExpr("block", "windows", "cast(null as bigint) source", f"{none} lent").unionByName(
        lent.selectExpr("block", f"{none} windows", "source", "lent"))
    first = written(table.groupBy("block").cogroup(given.groupBy("block")).applyInArrow(
        verify, "block long, place long, source_id long, start_word long, end_word long, shared long, bucket long, joined binary"), folder, "first")

    # 4. minima with unconfirmed links: their windows meet again, with the shingles around
    def pend(bucket, left, right):
        out = []
        if left.num_rows:
            joined = {b: unplanes(x, 4).view(np.int64) for b, x in zip(right["block"].to_pylist(), right["joined"].to_pylist())}
            key, block, within, done, row, l, r, c = _unpacked(_MEMBER, left["windows"].to_pylist())
            done = done > 0
            cut = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1], [True]]))
            for a, e in zip(cut[:-1], cut[1:]):
                if int(block[a]) in joined:
                    done[a:e] |= np.isin(within[a:e], joined[int(block[a])])
            open_ = np.isin(key, key[~done])
            for a, e in zip(cut[:-1], cut[1:]):
                i = a + np.flatnonzero(open_[a:e])
                if len(i):
                    out.append((int(block[a]), bucket[0].as_py(), planes(key[i], 5), _packed(_PENDING, done[i], row[i], l[i], r[i], c[i])))
        return _table(out, [("block", pa.int64()), ("bucket", pa.int64()), ("groups", pa.binary()), ("windows", pa.binary())])

    pending = written(links.where("kind = 3").withColumnRenamed("number", "bucket").groupBy("bucket")
                      .cogroup(first.where("joined is not null").select("bucket", "block", "joined").groupBy("bucket"))
                      .applyInArrow(pend, "block long, bucket long, groups binary, windows binary"), folder, "pending")

    def around(block, left, right):
        out = []
        if left.num_rows and right.num_rows:
            ids, raw, off = block_texts(left)
            asked = [(b, groups, _unpacked(_PENDING, [x])) for b, groups, x in zip(*(right[n].to_pylist() for n in ("bucket", "groups", "windows")))]
            rows = np.unique(np.concatenate([x[1] for _, _, x in asked]))
            s = _shingles_of(raw, off, rows)
            first_of = np.zeros(len(ids), np.int64)
            first_of[rows] = np.cumsum([0, *(len(s[k]) for k in rows.tolist())])[:-1]
            s = np.concatenate([(s[k] >> np.uint64(40)).astype(np.uint32) for k in rows.tolist()])
            for b, groups, (done, row, l, r, c) in asked:
                low, high = np.maximum(l, c - LEAST + 1), np.minimum(r, c + LEAST - 1) + 1
                size = high - low
                at = np.repeat(first_of[row] + low - np.cumsum(size) + size, size) + np.arange(size.sum())
                out.append((b, block[0].as_py(), groups, planes(ids[row]), planes(row, 5), planes(l, 5), planes(r, 5),
                            planes(done, 1), planes(size, 1), planes(s[at], 3)))
        return _table(out, [("bucket", pa.int64()), ("block", pa.int64()),
                            *((n, pa.binary()) for n in ("groups", "ids", "places", "l", "r", "joined", "sizes", "marks"))])

    def relink(bucket, group):
        blocks = group["block"].to_pylist()
        column = {n: [unplanes(x, w) for x in group[n].to_pylist()] for n, w in
                  (("groups", 5), ("ids", 8), ("places", 5), ("l", 5), ("r", 5), ("joined", 1), ("sizes", 1), ("marks", 3))}
        block = np.repeat(np.array(blocks), [len(x) for x in column["groups"]])
        key, doc, place, l, r, joined, size, marks = (np.concatenate(x).view(np.int64) for x in column.values())
        found = np.array(similar_links(key, doc, joined > 0, size, marks), np.int64).reshape(-1, 2)
        i, j = found[:, 0], found[:, 1]
        out = _asks(block[j], block[i], doc[j], l[j], r[j])
        for b in np.unique(block[i]).tolist():
            k = block[i] == b
            out.append((b, 1, None, planes(doc[j[k]]), planes(place[i[k]], 5), np.concatenate([l[i[k]], r[i[k]]]).astype("<u4").tobytes()))
        return _table(out, [("block", pa.int64()), ("kind", pa.int32()), ("number", pa.int64()), *((n, pa.binary()) for n in ("sources", "to", "bounds"))])

    relinks = written(
        table.groupBy("block").cogroup(pending.groupBy("block")).applyInArrow(
            around, "bucket long, block long, groups binary, ids binary, places binary, l binary, r binary, joined binary, sizes binary, marks binary")
        .groupBy("bucket").applyInArrow(relink, "block long, kind int, number long, sources binary, to binary, bounds binary"), folder, "relinks")
    relent = written(table.groupBy("block").cogroup(relinks.where("kind = 2").groupBy("block")).applyInArrow(
        lend, "block long, source long, lent binary"), folder, "relent")

    # 5. the exact check of these links; a pair's passages of both rounds are merged
    def finish(block, left, right):
        out = []
        if left.num_rows and right.num_rows:
            ids, raw, off = block_texts(left)
            pairs: dict[tuple[int, int], list] = {}
            lent_by: dict[int, list[np.ndarray]] = {}
            linked: dict[tuple[int, int], list] = {}
            for place, source, a, e, shared, lent_, sources, to, bounds in zip(*(right[n].to_pylist() for n in (
                    "place", "source", "start_word", "end_word", "shared", "lent", "sources", "to", "bounds"))):
                if lent_ is not None:
                    lent_by.setdefault(source, []).append(unplanes(lent_, 5))
                elif sources is not None:
                    l, r = np.frombuffer(bounds, "<u4").astype(np.int64).reshape(2, -1)
                    for x in zip(unplanes(to, 5).tolist(), unplanes(sources).view(np.int64).tolist(), l.tolist(), r.tolist()):
                        linked.setdefault(x[:2], []).append(x[2:])
                else:
                    pairs.setdefault((place, source), []).append((a, e, shared))
            known = {i: np.unique(np.concatenate(x)) for i, x in lent_by.items()}
            s = _shingles_of(raw, off, np.unique([k for k, _ in linked]))
            for (k, source), spans in linked.items():
                own, l, r = s[k] >> np.uint64(24), *(np.array(x) for x in zip(*spans))
                more = _verified(own, np.zeros(len(l), np.int64), l, r, known.get(source), 1)
                if more:
                    pairs[k, source] = _merged(pairs.get((k, source), []), more, np.isin(own, known[source]))
            out = [(int(ids[k]), source, *p) for (k, source), found in pairs.items() for p in found]
        return _table(out, [(n, pa.int64()) for n in ("doc_id", "source_id", "start_word", "end_word", "shared")])

    longs = ("place", "source", "start_word", "end_word", "shared")
    rounds = (
        first.where("joined is null").selectExpr("block", "place", "source_id source", *longs[2:], *(f"{none} {n}" for n in ("lent", "sources", "to", "bounds")))
        .unionByName(relent.selectExpr("block", "source", "lent"), allowMissingColumns=True)
        .unionByName(relinks.where("kind = 1").selectExpr("block", "sources", "to", "bounds"), allowMissingColumns=True)
    )
    return table.groupBy("block").cogroup(rounds.groupBy("block")).applyInArrow(
        finish, "doc_id long, source_id long, start_word long, end_word long, shared long")


def candidates(row: np.ndarray, source: np.ndarray, f: np.ndarray, l: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Which windows belong to a text and source that can share a passage: of LEAST successive shingles,
    8/9 are covered by windows of ENOUGH functions."""
    keep = np.zeros(len(row), bool)
    if not len(row):
        return keep
    order = np.lexsort((f, source, row))
    row, source, f, l, r = (x[order] for x in (row, source, f, l, r))
    new = np.concatenate([[True], (row[1:] != row[:-1]) | (source[1:] != source[:-1])])
    group = np.cumsum(new) - 1
    many = np.bincount(group, new | np.concatenate([[False], f[1:] != f[:-1]]))[group] >= ENOUGH
    order, f, l, r, new = (x[many] for x in (order, f, l, r, group))
    if not len(order):
        return keep
    cut = np.flatnonzero(np.concatenate([[True], new[1:] != new[:-1]]))
    group = np.cumsum(np.concatenate([[False], new[1:] != new[:-1]]))
    low = np.minimum.reduceat(l, cut)
    span = np.maximum.reduceat(r, cut) - low + 2 + LEAST
    first = np.cumsum(span) - span
    shift, total = (first - low)[group], int(span.sum())
    cover = np.zeros(total, np.int8)
    for j in range(HASHES):
        i = f == j
        cover += np.cumsum(np.bincount(l[i] + shift[i], minlength=total) - np.bincount(r[i] + 1 + shift[i], minlength=total)) > 0
    sums = np.concatenate([[0], np.cumsum(cover >= ENOUGH)])
    # LEAST empty places end each group: a run that starts at a covered place meets no other group
    good = np.flatnonzero((sums[LEAST:] - sums[:-LEAST] >= SHARE * LEAST - 1e-9) & (cover[: total - LEAST + 1] >= ENOUGH))
    found = np.zeros(len(cut), bool)
    found[np.searchsorted(first, good, "right") - 1] = True
    keep[order[found[group]]] = True
    return keep


def _shingles_of(raw: np.ndarray, off: np.ndarray, rows: np.ndarray) -> dict[int, np.ndarray]:
    """The shingles of some texts of a block, a few texts at a time."""
    out: dict[int, np.ndarray] = {}
    rows = rows.astype(np.int64)
    size = np.concatenate([[0], np.cumsum(off[rows + 1] - off[rows])])
    k = 0
    while k < len(rows):
        end = max(k + 1, int(np.searchsorted(size, size[k] + _PIECE, "right")) - 1)
        part = rows[k:end].tolist()
        h, _, _, first = words(np.concatenate([raw[off[i] : off[i + 1]] for i in part]), size[k : end + 1] - size[k])
        s, sf = shingles(h, first, WORDS)
        out.update((i, s[sf[j] : sf[j + 1]]) for j, i in enumerate(part))
        k = end
    return out


def _packed(widths, *columns) -> bytes:
    """Columns of integers behind each other, as planes of ``widths`` bytes."""
    return b"".join(planes(x, w) for x, w in zip(columns, widths))


def _unpacked(widths, parts) -> list[np.ndarray]:
    """The columns of all ``parts``, end to end."""
    out = []
    for k, w in enumerate(widths):
        column = [np.zeros(0, np.uint64)]
        for x in parts:
            n = len(x) // sum(widths)
            column.append(unplanes(x[n * sum(widths[:k]) : n * sum(widths[: k + 1])], w))
        out.append(np.concatenate(column).view(np.int64))
    return out


def _asks(source_block, block, source, low, high):
    """What blocks ask of the sources' blocks: shingles ``low`` to ``high`` of a document."""
    ask, inverse = np.unique(np.column_stack([source_block, block, source]), axis=0, return_inverse=True) if len(source) else (np.zeros((0, 3), np.int64), source)
    first, last = np.full(len(ask), 1 << 39), np.zeros(len(ask), np.int64)
    np.minimum.at(first, inverse.ravel(), low)
    np.maximum.at(last, inverse.ravel(), high)
    cut = np.flatnonzero(np.concatenate([[True], ask[1:, 0] != ask[:-1, 0]])) if len(ask) else []
    return [(int(ask[a, 0]), 2, None, planes(ask[a:e, 2]), planes(ask[a:e, 1]), np.concatenate([first[a:e], last[a:e]]).astype("<u4").tobytes())
            for a, e in zip(cut, [*cut[1:], len(ask)])]


def _merged(passages, more, hit):
    """Passages of one pair, (start word, end word, shared) each, overlapping ones united; ``hit``: the text's
    shingles that count where no earlier passage lies."""
    hit = hit.astype(np.int64)
    inside = np.zeros(len(hit), bool)
    for a, e, _ in more:
        inside[a : e - WORDS + 1] = True
    for a, e, shared in passages:  # an earlier passage keeps its count
        hit[a : e - WORDS + 1] = 0
        hit[a] = shared
        inside[a : e - WORDS + 1] = True
    edge = np.flatnonzero(np.diff(np.concatenate([[0], inside, [0]])))
    return [(int(a), int(e) + WORDS - 1, int(hit[a:e].sum())) for a, e in edge.reshape(-1, 2)]


def _table(out, schema) -> pa.Table:
    return pa.table({name: pa.array([x[k] for x in out], kind) for k, (name, kind) in enumerate(schema)})


def _verified(s, f, l, r, known, enough=ENOUGH):
    """Passages of one text that its source confirms: (start word, end word, shared shingles)."""
    if known is None or not len(known) or len(s) < LEAST:
        return []
    begin = max(0, int(l.min()) - LEAST)  # nothing is covered before l or behind r; a passage may reach beyond
    s, l, r = s[begin : int(r.max()) + 1 + LEAST], l - begin, r - begin
    cover = np.zeros(len(s) + 1, np.int64)
    for j in np.unique(f):  # each function counts once however many of its windows cover a shingle
        i = f == j
        cover += np.cumsum(np.bincount(l[i], minlength=len(s) + 1) - np.bincount(np.minimum(r[i] + 1, len(s)), minlength=len(s) + 1)) > 0
    candidate = cover[:-1] >= enough
    at = np.minimum(np.searchsorted(known, s), len(known) - 1)
    hit = (known[at] == s) & candidate
    sums = np.concatenate([[0], np.cumsum(hit)])
    good = np.flatnonzero(sums[LEAST:] - sums[:-LEAST] >= SHARE * LEAST - 1e-9)
    if not len(good):
        return []
    cut = np.flatnonzero(np.concatenate([[True], good[1:] > good[:-1] + LEAST]))
    starts, ends = good[cut], good[np.concatenate([cut[1:] - 1, [len(good) - 1]])] + LEAST
    return [(int(a) + begin, int(b) + begin + WORDS - 1, int(sums[b] - sums[a])) for a, b in zip(starts, ends)]

"""Kernels for one tile: a block of items against a block of queries."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_CELLS = 1_000_000  # scores held at once: 8 MB of doubles
QUERIES, ITEMS, BARE = range(3)  # kinds of packed blocks, in the order they reach a task


def _matrix(column: pa.ChunkedArray) -> np.ndarray | None:
    """Lists of equal length as rows of a matrix; a missing list is a zero row."""
    lists = column.combine_chunks()
    present = np.asarray(lists.is_valid())
    if not present.any():
        return None
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    width = values.size // int(present.sum())
    matrix = np.zeros((len(lists), width))
    matrix[present] = values.reshape(-1, width)
    return matrix


class Asked:
    """A block of queries, with the matrices that every block of items meets."""

    def __init__(self, queries: pa.Table):
        self.table = queries
        self.als, self.word = _matrix(queries["als_q"]), _matrix(queries["word_q"])
        self.weight, self.shift = queries["weight"].to_numpy(), queries["shift"].to_numpy()


class Shown:
    """A block of items, unpacked once for all queries that it meets."""

    def __init__(self, items: pa.Table):
        self.size = items.num_rows
        self.popularity = items["popularity"].to_numpy()
        self.als, self.word = _matrix(items["als"]), _matrix(items["word"])
        if self.word is not None:
            norms = np.nan_to_num(items["word_norm"].to_numpy())
            self.word /= np.where(norms > 0, norms, 1.0)[:, None]

    def scores(self, asked: Asked) -> Iterator[tuple[int, np.ndarray]]:
        """(first query, scores of all items for some queries), slice by slice."""
        if self.size == 0:
            return
        step = max(1, SLICE_CELLS // self.size)
        for first in range(0, asked.table.num_rows, step):
            part = slice(first, first + step)
            scores = np.outer(asked.weight[part], self.popularity)
            if self.als is not None and asked.als is not None:
                scores += asked.als[part] @ self.als.T
            if self.word is not None and asked.word is not None:
                scores += asked.word[part] @ self.word.T
            scores += asked.shift[part, None]
            yield first, scores


def _packed(table: pa.Table) -> bytes:
    """A table as one binary value; lists of equal length lose their offsets."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def _unpacked(value: pa.Scalar) -> pa.Table:
    return pa.ipc.open_stream(value.as_buffer()).read_all()


def pack_kernel(number: str, order: str | None = None) -> Callable[[pa.Table], pa.Table]:
    """One row (number, block) for all rows of a block, sorted by ``order``."""

    def pack(rows: pa.Table) -> pa.Table:
        if order is not None:
            rows = rows.take(pc.sort_indices(rows[order]))
        return pa.table({number: rows[number].slice(0, 1), "block": pa.array([_packed(rows.drop_columns([number]))])})

    return pack


def meeting(start: Callable[[], Spans | Best]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Packed blocks (cell, kind, block) through a state of their cell, which ``start`` makes.

    Rows come cell by cell, blocks of queries before blocks of items. Of the items only one
    block is unpacked at a time; the state holds what the queries need.
    """

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = here = None
        for batch in batches:
            for cell, kind, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if cell != here:
                    if state is not None:
                        yield from state.finish()
                    state, here = start(), cell
                if kind == QUERIES:
                    # A copy, as the batch holds blocks of items, too.
                    state.asked.append(state.query(pa.ipc.open_stream(block.as_py()).read_all()))
                else:
                    state.meet(_unpacked(block))
        if state is not None:
            yield from state.finish()

    return meet


class Spans:
    """Smallest and largest score of every query of a cell."""

    def __init__(self, keys: list[str], schema: pa.Schema):
        self.keys, self.schema, self.asked = keys, schema, []

    def query(self, table: pa.Table) -> tuple[Asked, np.ndarray, np.ndarray]:
        return Asked(table), np.full(table.num_rows, np.inf), np.full(table.num_rows, -np.inf)

    def meet(self, items: pa.Table) -> None:
        shown = Shown(items)
        for asked, low, high in self.asked:
            for first, scores in shown.scores(asked):
                part = slice(first, first + len(scores))
                low[part] = np.minimum(low[part], scores.min(axis=1))
                high[part] = np.maximum(high[part], scores.max(axis=1))

    def finish(self) -> Iterator[pa.RecordBatch]:
        for asked, low, high in self.asked:
            met = ~np.isposinf(low) | ~np.isneginf(high)
            columns = {k: asked.table[k] for k in self.keys}
            table = pa.table({**columns, "low": low, "high": high}).filter(pa.array(met))
            yield from table.select(self.schema.names).cast(self.schema).to_batches()


def best_positions(scores: np.ndarray, k: int, floor: float) -> np.ndarray:
    """Positions of the ``k`` largest scores from ``floor`` up; of equals, the first."""
    found = np.flatnonzero(scores >= floor)
    if k >= found.size:
        return found
    scores = scores[found]
    cut = np.partition(scores, scores.size - k)[scores.size - k]
    above = np.flatnonzero(scores > cut)
    level = np.flatnonzero(scores == cut)[: k - above.size]
    return found[np.concatenate([above, level])]


class Best:
    """The ``keep`` best items of every query of a cell, from its floor up, without those of ``gone``.

    Equal scores are taken by the smallest URI; in a block, items come in URI order. What a
    query holds is cut to ``keep`` whenever it has grown by half, and the last of them is
    its floor from then on, so the rest of the blocks adds little. With ``want``, lists are ranked
    whole, and then only the rows of the items in it leave.
    """

    def __init__(self, keys: list[str], schema: pa.Schema):
        self.keys, self.schema, self.asked = keys, schema, []
        self.uris, self.total = [], 0

    def query(self, table: pa.Table) -> dict:
        keep, rows = table["keep"].to_numpy(), table.num_rows
        gone = table["gone"].combine_chunks()
        sizes = pc.fill_null(pc.list_value_length(gone), 0).to_numpy()
        none = np.empty(0), np.empty(0, np.int32)
        return {
            "asked": Asked(table.drop_columns(["gone"])), "keep": keep, "most": keep + np.maximum(keep // 2, 64),
            "floor": table["floor"].to_numpy().copy(), "gone": gone.flatten(), "of": np.repeat(np.arange(rows), sizes),
            "held": [[none] for _ in range(rows)], "sizes": np.zeros(rows, np.int64),
        }

    def meet(self, items: pa.Table) -> None:
        shown, names, begin = Shown(items), items["track_uri"].combine_chunks(), self.total
        self.uris.append(pa.concat_arrays([names]))
        self.total += shown.size
        # Rows of the same URI lie one after another; what is gone is gone with all of them.
        fresh = np.ones(shown.size, bool)
        if shown.size > 1:
            fresh[1:] = ~pc.fill_null(pc.equal(names.slice(1), names.slice(0, shown.size - 1)), False).to_numpy(zero_copy_only=False)
        begins = np.flatnonzero(fresh)
        copies = np.zeros(shown.size, np.int64)
        copies[begins] = np.diff(np.append(begins, shown.size))
        for q in self.asked:
            at = pc.index_in(q["gone"], value_set=names, skip_nulls=True)
            known = np.asarray(at.is_valid())
            of, at = q["of"][known], pc.drop_null(at).to_numpy()
            times = copies[at]
            of, at = np.repeat(of, times), np.repeat(at, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            for first, scores in shown.scores(q["asked"]):
                mine = (of >= first) & (of < first + len(scores))
                scores[of[mine] - first, at[mine]] = np.nan
                for query, row in enumerate(scores, start=first):
                    chosen = best_positions(row, int(q["keep"][query]), q["floor"][query])
                    if chosen.size:
                        q["held"][query].append((row[chosen], (chosen + begin).astype(np.int32)))
                        q["sizes"][query] += chosen.size
                        if q["sizes"][query] > q["most"][query]:
                            self.cut(q, query)

    def cut(self, q: dict, query: int) -> tuple[np.ndarray, np.ndarray]:
        """(scores, items) that a query holds, down to ``keep``."""
        scores, items = (np.concatenate(x) for x in zip(*q["held"][query], strict=True))
        keep = int(q["keep"][query])
        if keep < scores.size:
            least = np.partition(scores, scores.size - keep)[scores.size - keep]
            above, level = np.flatnonzero(scores > least), np.flatnonzero(scores == least)
            if above.size + level.size > keep:
                level = level[self.order(items[level])[: keep - above.size]]
            chosen = np.concatenate([above, level])
            scores, items = scores[chosen], items[chosen]
            q["floor"][query] = max(q["floor"][query], least)
        q["held"][query], q["sizes"][query] = [(scores, items)], scores.size
        return scores, items

    def names(self, items: np.ndarray) -> pa.ChunkedArray:
        return pa.chunked_array(self.uris, pa.string()).take(pa.array(items))

    def order(self, items: np.ndarray) -> np.ndarray:
        """Places of the items by URI; without one, first."""
        return pc.sort_indices(self.names(items).combine_chunks(), null_placement="at_start").to_numpy()

    def finish(self) -> Iterator[pa.RecordBatch]:
        for q in self.asked:
            table, owner, found, values, ranks = q["asked"].table, [], [], [], []
            want = table["want"].combine_chunks() if "want" in table.column_names else None
            for query in range(table.num_rows):
                scores, items = self.cut(q, query)
                order = np.argsort(-scores, kind="stable")
                scores, items = scores[order], items[order]
                if (scores[1:] == scores[:-1]).any():
                    places = np.empty(items.size, np.int64)
                    places[self.order(items)] = np.arange(items.size)
                    order = np.lexsort((places, -scores))
                    scores, items = scores[order], items[order]
                rank = np.arange(1, items.size + 1)
                if want is not None:
                    listed = want[query].values
                    kept = np.zeros(items.size, bool)
                    if listed is not None and len(listed):
                        kept = pc.is_in(self.names(items).combine_chunks(), value_set=listed, skip_nulls=True).to_numpy(zero_copy_only=False)
                    scores, items, rank = scores[kept], items[kept], rank[kept]
                q["held"][query] = None
                owner.append(np.full(items.size, query))
                found.append(items)
                values.append(scores)
                ranks.append(rank)
            if not sum(map(len, found)):
                continue
            rows = table.select(self.keys).take(pa.array(np.concatenate(owner)))
            columns = {k: rows[k] for k in self.keys}
            columns |= {"track_uri": self.names(np.concatenate(found)), "score": np.concatenate(values), "rank": np.concatenate(ranks)}
            yield from pa.table(columns).select(self.schema.names).cast(self.schema).combine_chunks().to_batches()


# --- packed blocks ------------------------------------------------------------


def _vectors(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Lists of one length, none missing, as rows of a matrix."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)


def _as_bytes(matrix: np.ndarray) -> bytes:
    """Rows of a matrix, as 32-bit numbers where those are the same."""
    narrow = matrix.astype(np.float32)
    same = (narrow == matrix).all()
    return (b"f" + narrow.tobytes()) if same else (b"d" + matrix.tobytes())


def _unpack(ids: bytes, vectors: bytes) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, np.int64)
    kind = np.float32 if vectors[:1] == b"f" else np.float64
    return ids, np.frombuffer(vectors, kind, offset=1).reshape(len(ids), -1).astype(np.float64)


def pack_items(rows: pa.Table) -> pa.Table:
    """One row for a block of items; they come in order of their ids."""
    order = np.argsort(rows["item_id"].to_numpy(), kind="stable")
    return pa.table(
        {
            "block": pa.array([rows["block"][0].as_py()], pa.int64()),
            "ids": pa.array([rows["item_id"].to_numpy()[order].astype(np.int64).tobytes()], pa.binary()),
            "vectors": pa.array([_as_bytes(_vectors(rows["features"])[order])], pa.binary()),
            "longest": pa.array([float(rows["norm"].to_numpy().max())]),
        }
    )


def pack_users(rows: pa.Table) -> pa.Table:
    """One row for a block of users, with their floors and the largest reach."""
    return pa.table(
        {
            "level": pa.array([rows["level"][0].as_py()], pa.int32()),
            "part": pa.array([rows["part"][0].as_py()], pa.int64()),
            "ids": pa.array([rows["user_id"].to_numpy().astype(np.int64).tobytes()], pa.binary()),
            "vectors": pa.array([_as_bytes(_vectors(rows["features"]))], pa.binary()),
            "floors": pa.array([rows["floor"].to_numpy().astype(np.float64).tobytes()], pa.binary()),
            "reach": pa.array([int(rows["reach"].to_numpy().max())], pa.int64()),
        }
    )


def _best(
    people: np.ndarray, items: np.ndarray, floors: np.ndarray, n: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, scores) of the n best items of each user that reach its floor.

    The product only chooses; a margin keeps what its rounding might lose. Scores are
    then summed pair by pair, which gives equal vectors equal scores.
    """
    step = max(1, SLICE_CELLS // max(1, len(items)))
    length = np.sqrt((items * items).sum(axis=1)).max(initial=0.0)
    for first in range(0, len(people), step):
        some = people[first : first + step]
        margins = 1e-12 * length * np.sqrt((some * some).sum(axis=1)) * max(1, some.shape[1])
        for x, row, margin, floor in zip(some, some @ items.T, margins, floors[first : first + step], strict=True):
            cut = floor - margin
            if n < row.size:
                cut = max(cut, np.partition(row, row.size - n)[row.size - n] - margin)
            near = np.flatnonzero(row >= cut)
            exact = (items[near] * x).sum(axis=1)
            chosen = best_positions(exact, n, floor)
            yield near[chosen], exact[chosen]


def first_kernel(
    ids: bytes, vectors: bytes, longest: list[float], n: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Lists of users from the first block of items, and how many blocks may matter."""
    falling = -np.array(longest)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, items = _unpack(ids, vectors)
        for batch in batches:
            if not batch.num_rows:
                continue
            people = _vectors(batch.column(1))
            floors, reach, found, scores = [], [], [], []
            lengths = np.sqrt((people * people).sum(axis=1))
            for x, (at, values) in zip(lengths, _best(people, items, np.full(len(people), -np.inf), n), strict=True):
                floor = float(values.min()) if len(values) >= n else -np.inf
                # Blocks whose longest item may reach the floor, the rounding included.
                least = (floor - 1e-9 * abs(floor)) / x if x > 0 and floor > 0 else -np.inf
                floors.append(floor)
                reach.append(int(np.searchsorted(falling, -least, side="right")))
                found.append(names[at])
                scores.append(values)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(floors, pa.float64()),
                    pa.array(reach, pa.int64()),
                    pa.array(found, pa.list_(pa.int64())),
                    pa.array(scores, pa.list_(pa.float64())),
                ],
                ["user_id", "features", "floor", "reach", "items", "scores"],
            )

    return search


class _People:
    """A block of users, and what each has found so far from its floor up."""

    def __init__(self, ids: bytes, vectors: bytes, floors: bytes, reach: int):
        self.ids, self.vectors, self.reach = ids, vectors, reach
        self.floors = np.frombuffer(floors, np.float64).copy()
        self.found: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def meet(self, names: np.ndarray, items: np.ndarray, narrow: np.ndarray, length: float, n: int) -> None:
        _, people = _unpack(self.ids, self.vectors)
        step = max(1, SLICE_CELLS // len(items))
        # The product of 32-bit numbers only chooses; the margin keeps what its rounding might lose.
        margins = 2.0**-23 * (people.shape[1] + 4) * length * np.sqrt((people * people).sum(axis=1)) + 1e-30
        cuts = np.nextafter((self.floors - margins).astype(np.float32), np.float32(-np.inf))
        for first in range(0, len(people), step):
            some = slice(first, first + step)
            user, near = np.nonzero(people[some].astype(np.float32) @ narrow.T >= cuts[some, None])
            if not user.size:
                continue
            begins = np.flatnonzero(np.diff(user, prepend=-1))
            for low, high in zip(begins, [*begins[1:], len(user)], strict=True):
                at = first + int(user[low])
                exact = (items[near[low:high]] * people[at]).sum(axis=1)
                chosen = best_positions(exact, n, self.floors[at])
                if chosen.size:
                    self.add(at, names[near[low:high]][chosen], exact[chosen], n)

    def add(self, at: int, ids: np.ndarray, scores: np.ndarray, n: int) -> None:
        if at in self.found:
            held, values = self.found[at]
            ids, scores = np.concatenate([held, ids]), np.concatenate([values, scores])
        if len(ids) > n:
            order = np.lexsort((ids, -scores))[:n]
            ids, scores = ids[order], scores[order]
        if len(ids) == n:
            self.floors[at] = max(self.floors[at], scores.min())
        self.found[at] = ids, scores


def further_kernel(n: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The n best items of each user of a group, from its floor up, as blocks of items pass.

    Rows (group, block, ids, vectors, floors, reach) come group by group, blocks of users
    (block 0) before those of items by their number. A block of users meets the
    ones below its reach.
    """

    def found(people: list[_People]) -> Iterator[pa.RecordBatch]:
        for block in people:
            if block.found:
                users, places = np.frombuffer(block.ids, np.int64), list(block.found)
                sizes = [len(block.found[at][0]) for at in places]
                columns = [np.repeat(users[places], sizes), *(np.concatenate([block.found[at][i] for at in places]) for i in (0, 1))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["user_id", "item_id", "score"])

    def further(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, people = None, []
        for batch in batches:
            for row in range(batch.num_rows):
                group, block = (batch.column(i)[row].as_py() for i in (0, 1))
                if group != here:
                    yield from found(people)
                    here, people = group, []
                if block == 0:
                    people.append(_People(*(batch.column(i)[row].as_py() for i in (2, 3, 4, 5))))
                elif any(block < p.reach for p in people):
                    names, items = _unpack(*(batch.column(i)[row].as_py() for i in (2, 3)))
                    length = np.sqrt((items * items).sum(axis=1)).max(initial=0.0)
                    narrow = items.astype(np.float32)
                    for p in people:
                        if block < p.reach:
                            p.meet(names, items, narrow, length, n)
        yield from found(people)

    return further


# --- equations of users --------------------------------------------------------


def pack_vectors(rows: pa.Table) -> pa.Table:
    """One row for a block of vectors, in order of their ids."""
    order = np.argsort(rows["id"].to_numpy(), kind="stable")
    return pa.table(
        {
            "block": pa.array([rows["block"][0].as_py()], pa.int32()),
            "ids": pa.array([rows["id"].to_numpy()[order].tobytes()], pa.binary()),
            "vectors": pa.array([_as_bytes(_vectors(rows["vector"])[order])], pa.binary()),
        }
    )


def _find(ids: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, whether found) in sorted ids."""
    if not len(ids):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(ids, wanted), len(ids) - 1)
    return at, ids[at] == wanted


def residual_kernel(
    gram: np.ndarray, reg: float, alpha: float
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(user_id, ratings, residual) of groups of users.

    Rows (group, block, kind, user, item, rating, ids, vectors) come group by group: blocks of
    users, then every block of items before the ratings of its items.
    """
    rank = len(gram)

    def finish(users, x, left, right, count):
        for first in range(0, len(users), 16_384):
            part = slice(first, first + 16_384)
            some = x[part].astype(np.float64)
            gap = some @ gram + left[part] + reg * count[part, None] * some
            with np.errstate(invalid="ignore", divide="ignore"):
                residual = np.sqrt((gap * gap).sum(axis=1)) / np.sqrt((right[part] * right[part]).sum(axis=1))
            met = count[part] > 0
            columns = [pa.array(c[met]) for c in (users[part], count[part], residual)]
            yield pa.RecordBatch.from_arrays(columns, ["user_id", "ratings", "residual"])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, state, packed, ids, y = None, None, [], None, None
        for batch in batches:
            groups, kinds = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            cuts = np.flatnonzero((np.diff(groups) != 0) | (np.diff(kinds) != 0) | (kinds[1:] != 2)) + 1
            for low, high in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if low == high:
                    continue
                if groups[low] != here:
                    if state is not None:
                        yield from finish(*state)
                    here, state, packed, ids, y = groups[low], None, [], None, None
                if kinds[low] == 0:
                    packed.append(_unpack_narrow(*(batch.column(i)[low].as_py() for i in (6, 7))))
                    continue
                if state is None:
                    users = np.concatenate([p[0] for p in packed] or [np.zeros(0, np.int64)])
                    order = np.argsort(users)
                    x = np.concatenate([p[1] for p in packed])[order] if packed else np.zeros((0, rank), np.float32)
                    packed, zeros = [], np.zeros((2, len(users), rank))
                    state = users[order], x, zeros[0], zeros[1], np.zeros(len(users), np.int64)
                if kinds[low] == 1:
                    ids, y = _unpack(*(batch.column(i)[low].as_py() for i in (6, 7)))
                    block = batch.column(1)[low].as_py()
                    continue
                if ids is None or batch.column(1)[low].as_py() != block:
                    continue
                _add_ratings(state, ids, y, *(batch.column(i).slice(low, high - low).to_numpy() for i in (3, 4, 5)), alpha)
        if state is not None:
            yield from finish(*state)

    return solve


def _unpack_narrow(ids: bytes, vectors: bytes) -> tuple[np.ndarray, np.ndarray]:
    kind = np.float32 if vectors[:1] == b"f" else np.float64
    ids = np.frombuffer(ids, np.int64)
    return ids, np.frombuffer(vectors, kind, offset=1).reshape(len(ids), -1)


def _add_ratings(state, ids, y, users, items, ratings, alpha: float) -> None:
    """Adds what ratings of a block of items give to both sides of their users' equations."""
    known, x, left, right, count = state
    user, rated = _find(known, users)
    item, present = _find(ids, items)
    kept = np.flatnonzero(rated & present)
    kept = kept[np.argsort(user[kept], kind="stable")]
    if not kept.size:
        return
    user, own, more = user[kept], y[item[kept]], alpha * ratings[kept].astype(np.float64)
    product = np.einsum("ij,ij->i", x[user].astype(np.float64), own)
    begins = np.flatnonzero(np.diff(user, prepend=-1))
    of = user[begins]
    left[of] += np.add.reduceat((more * product - more - 1)[:, None] * own, begins)
    right[of] += np.add.reduceat((more + 1)[:, None] * own, begins)
    count[of] += np.diff(np.append(begins, user.size))

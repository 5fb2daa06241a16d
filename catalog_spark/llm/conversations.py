"""Repair of conversations: the cheapest edits that make their roles alternate, by Hirschberg's divide and conquer.

The roles' initials must read ``(s?(ua)+)?``, an automaton with four states: at the start, after a system turn, after a
user's, after an assistant's. Keeping a row is free, a new role costs 3, deleting 4, inserting an empty turn 3, and an
undeleted truncated row 3 more; blank and duplicate rows must go. Of equally cheap edits the ASCII-least audit counts.

A vector of four costs runs forward from the first row and one runs backward from the last; they meet mid-conversation,
where the crossing state with the least sum is fixed, and both halves are solved alike. So no table of rows by states is
kept. Among equal sums the audit-least prefix decides: the audits of all prefixes that end with an edit of the same row
are different, and none begins another, so their order is that of whole audits. The forward vector carries that order as
a rank of each state, which needs only the last ranks and the letters of one step.

A conversation may have any number of rows. Rows are sorted by range, so that a long one lies in several partitions, and
cut into pieces of ``PIECE_ROWS`` rows at most. A piece's costs and ranks from each state to each state (16 of each)
are all that the other pieces must know of it, so crossings between pieces are found first, by the same two passes over
pieces, and then each piece is solved by itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import forget, map_arrow, materialise, shuffle_partitions, slices

PIECE_ROWS = 4096
PIECE_CHARS = 4 << 20
START, SYSTEM, USER, ASSISTANT = range(4)
INSERTED = (USER, USER, ASSISTANT, USER)  # the state after an inserted turn, by the state before
ROLES = {USER: "user", ASSISTANT: "assistant"}
TAIL = ((0, ""), (6, "II"), (3, "I"), (0, ""))  # what ends a conversation, by state
INITIALS = "sua"
MUST_GO, TRUNCATED = 4, 8  # a row's class is its initial's place in INITIALS (3: another one) plus these
FAULTS = ("", "blank", "duplicate", "truncated")
LEGAL = {"su", "ua", "au"}
NEVER = 1 << 60

Vector = list[tuple[int, int]]  # cost and rank, by state


def kept(initial: int, state: int) -> int | None:
    """The state after a row that stays as it is, if it may stand there."""
    allowed = ((START,), (START, SYSTEM, ASSISTANT), (USER,), ())[initial]
    return initial + 1 if state in allowed else None


@cache
def steps(kind: int) -> tuple[tuple[tuple[int, str] | None, ...], ...]:
    """For each state before and after a row of a class: the cheapest edits, a run of inserts and the row's own, and of
    equally cheap ones the ASCII-least."""
    initial, extra = kind % 4, 3 if kind & TRUNCATED else 0
    out: list[list[tuple[int, str] | None]] = [[None] * 4 for _ in range(4)]
    for before in range(4):
        state, cost, letters = before, 0, ""
        for _ in range(4):
            ways = [(state, 4, "D")]
            if not kind & MUST_GO:
                ways.append((INSERTED[state], 3 + extra, "R"))
                if (after := kept(initial, state)) is not None:
                    ways.append((after, extra, "K"))
            for after, more, letter in ways:
                one = (cost + more, letters + letter)
                if out[before][after] is None or one < out[before][after]:
                    out[before][after] = one
            state, cost, letters = INSERTED[state], cost + 3, letters + "I"
    return tuple(map(tuple, out))


def at_state(state: int) -> Vector:
    return [(0, 0) if q == state else (NEVER, 0) for q in range(4)]


def _ranked(best: list[tuple | None]) -> Vector:
    order = {key: k for k, key in enumerate(sorted({b[1:] for b in best if b}))}
    return [(b[0], order[b[1:]]) if b else (NEVER, 0) for b in best]


def forward(kinds: bytes, vector: Vector) -> Vector:
    """Costs and ranks after the rows."""
    for kind in kinds:
        step, best = steps(kind), [None] * 4
        for q, (cost, rank) in enumerate(vector):
            if cost < NEVER:
                for after, way in enumerate(step[q]):
                    if way is not None:
                        one = (cost + way[0], rank, way[1])
                        if best[after] is None or one < best[after]:
                            best[after] = one
        vector = _ranked(best)
    return vector


def backward(kinds: bytes, costs: list[int]) -> list[int]:
    """Costs before the rows, given those after them."""
    for kind in reversed(kinds):
        costs = [min((way[0] + c for way, c in zip(row, costs) if way is not None), default=NEVER) for row in steps(kind)]
    return costs


def crossing(before: Vector, after: list[int]) -> int:
    return min(range(4), key=lambda q: (before[q][0] + after[q], before[q][1]))


def solve(kinds: bytes, first: int, last: int) -> list[str]:
    """The letters of each row's edits (its inserts first), from state ``first`` to state ``last``."""
    out, todo = [""] * len(kinds), [(0, len(kinds), first, last)]
    while todo:
        low, high, a, b = todo.pop()
        if high - low == 1:
            out[low] = steps(kinds[low])[a][b][1]
        elif low < high:
            mid = (low + high) // 2
            q = crossing(forward(kinds[low:mid], at_state(a)), backward(kinds[mid:high], [0 if s == b else NEVER for s in range(4)]))
            todo += [(low, mid, a, q), (mid, high, q, b)]
    return out


def ends(kinds: bytes, first: int = START) -> int:
    """The state in which the last row of a conversation leaves it, before what TAIL adds."""
    return crossing(forward(kinds, at_state(first)), [t[0] for t in TAIL])


Matrix = list[Vector]


def matrix(kinds: bytes) -> Matrix:
    return [forward(kinds, at_state(q)) for q in range(4)]


def through(vector: Vector, piece: Matrix) -> Vector:
    """``forward`` over a whole piece."""
    best: list[tuple | None] = [None] * 4
    for q, (cost, rank) in enumerate(vector):
        for after, (more, place) in enumerate(piece[q]):
            if cost < NEVER and more < NEVER and (best[after] is None or (cost + more, rank, place) < best[after]):
                best[after] = (cost + more, rank, place)
    return _ranked(best)


def states_between(pieces: list[Matrix]) -> list[int]:
    """The states before, between and after the pieces of a conversation, by the same halving."""
    out = [START] * (len(pieces) + 1)
    whole = at_state(START)
    for p in pieces:
        whole = through(whole, p)
    out[-1] = crossing(whole, [t[0] for t in TAIL])
    todo = [(0, len(pieces))]
    while todo:
        low, high = todo.pop()
        if high - low < 2:
            continue
        mid = (low + high) // 2
        ahead = at_state(out[low])
        for p in pieces[low:mid]:
            ahead = through(ahead, p)
        costs = [0 if q == out[high] else NEVER for q in range(4)]
        for p in reversed(pieces[mid:high]):
            costs = [min((p[q][s][0] + costs[s] for s in range(4) if p[q][s][0] < NEVER), default=NEVER) for q in range(4)]
        out[mid] = crossing(ahead, costs)
        todo += [(low, mid), (mid, high)]
    return out


def last_sign(text: Column) -> Column:
    """The last character that is not white space; empty if there is none."""
    return F.substring(F.rtrim(text, F.lit(" \t\n\v\f\r")), -1, 1)


def _initial(role: str) -> int:
    at = INITIALS.find(role[:1]) if role else -1
    return at if at >= 0 else 3


def _cut(batches, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows (conv, role, text, sign), sorted: their pieces, places, classes and faults within the piece's partition."""
    part = TaskContext.get().partitionId()
    piece, rows, chars, conv, seen = -1, 0, 0, None, set()
    for b in batches:
        for some, texts in slices(b, b.column(2)):
            out: dict[str, list] = {name: [] for name in ("piece", "place", "kind", "fault", "key")}
            for c, role, text, sign in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), texts, some.column(3).to_pylist()):
                if piece < 0 or c != conv or rows == PIECE_ROWS or chars > PIECE_CHARS:
                    if piece < 0 or c != conv:
                        seen = set()
                    piece, rows, chars, conv = piece + 1, 0, 0, c
                key = hashlib.sha256(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass")).digest()[:16]
                fault = 1 if not sign else 2 if key in seen else 3 if sign not in ".!?" else 0
                seen.add(key)
                for name, value in (("piece", part << 32 | piece), ("place", rows), ("kind", _initial(role) + (MUST_GO if fault in (1, 2) else TRUNCATED if fault == 3 else 0)), ("fault", fault), ("key", key)):
                    out[name].append(value)
                rows, chars = rows + 1, chars + len(text)
            more = [pa.array(out[f.name], f.type) for f in schema]
            yield pa.RecordBatch.from_arrays([*some.columns[:3], *more], ["conv", "role", "text", *schema.names])


CUT = pa.schema([("piece", pa.int64()), ("place", pa.int32()), ("kind", pa.int32()), ("fault", pa.int32()), ("key", pa.binary())])
EDIT = pa.schema([("piece", pa.int64()), ("place", pa.int32()), ("op", pa.string()), ("was", pa.string()), ("role", pa.string()), ("text", pa.string()), ("fault", pa.string())])


def _pieces(rows: DataFrame) -> DataFrame:
    """``rows`` (conv, turn, role, text) in order, cut into pieces, with classes that hold within a partition."""
    kind = rows.schema["conv"].dataType.simpleString()
    lined = rows.repartitionByRange(shuffle_partitions(rows.sparkSession), "conv", "turn", "role", F.substring("text", 1, 64)).sortWithinPartitions("conv", "turn", "role", "text")
    lined = lined.select("conv", "role", "text", last_sign(F.col("text")).alias("sign"))
    return materialise(map_arrow(lined, lambda batches: _cut(batches, CUT), f"conv {kind}, role string, text string, piece long, place int, kind int, fault int, key binary"))


def _crossings(cut: DataFrame) -> DataFrame:
    """(conv, piece, kinds, faults, first, last, ends) for conversations of several pieces: each piece's classes, with
    duplicates of rows in earlier pieces, its states at both ends, and whether it is the last."""
    several = cut.groupBy("conv").agg(F.min("piece").alias("low"), F.max("piece").alias("high")).filter("low < high").select(F.col("conv").alias("_conv"))
    narrow = cut.join(several, F.col("conv").eqNullSafe(F.col("_conv")), "left_semi").select("conv", "piece", "place", "kind", "fault", "key")
    earliest = narrow.groupBy("conv", "key").agg(F.min("piece").alias("_first")).withColumnsRenamed({"conv": "_conv", "key": "_key"})
    known = narrow.join(earliest, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("key") == F.col("_key")))
    again = (F.col("piece") > F.col("_first")) & (F.col("fault") != 1)
    row = F.struct("place", F.when(again, F.expr(f"kind % 4 + {MUST_GO}")).otherwise(F.col("kind")).alias("kind"), F.when(again, 2).otherwise(F.col("fault")).alias("fault"))
    listed = known.groupBy("conv", "piece").agg(F.array_sort(F.collect_list(row)).alias("rows"))  # PIECE_ROWS at most
    kind = cut.schema["conv"].dataType.simpleString()

    def measure(batches):
        for b in batches:
            kinds = [bytes(r["kind"] for r in rows) for rows in b.column(2).to_pylist()]
            faults = [bytes(r["fault"] for r in rows) for rows in b.column(2).to_pylist()]
            costs = [[c for row in matrix(k) for pair in row for c in pair] for k in kinds]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(kinds), pa.array(faults), pa.array(costs, pa.list_(pa.int64()))], ["conv", "piece", "kinds", "faults", "costs"])

    measured = materialise(map_arrow(listed, measure, f"conv {kind}, piece long, kinds binary, faults binary, costs array<long>"))

    def join(table: pa.Table) -> pa.Table:
        table = table.sort_by("piece")
        pieces = [[[(c[8 * q + 2 * s], c[8 * q + 2 * s + 1]) for s in range(4)] for q in range(4)] for c in table.column("costs").to_pylist()]
        states = states_between(pieces)
        n = table.num_rows
        return table.select(["conv", "piece"]).append_column("first", pa.array(states[:-1], pa.int32())).append_column("last", pa.array(states[1:], pa.int32())).append_column("ends", pa.array([k == n - 1 for k in range(n)]))

    ends_of = measured.select("conv", "piece", "costs").groupBy("conv").applyInArrow(join, f"conv {kind}, piece long, first int, last int, ends boolean")
    out = materialise(measured.drop("costs").join(ends_of.withColumnRenamed("conv", "_conv"), "piece").drop("_conv"))
    forget(measured)
    return out


def _edits(batches, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by piece and place, a crossing (place -1) ahead of its piece's: every edit in order."""

    def done(conv, rows: list[tuple], head: tuple | None) -> pa.RecordBatch:
        kinds, faults = (head[0], head[1]) if head else (bytes(r[2] for r in rows), bytes(r[3] for r in rows))
        first, last, final = head[2:] if head else (START, ends(kinds), True)
        out: list[tuple] = []
        state = first

        def insert() -> None:
            nonlocal state
            state = INSERTED[state]
            out.append(("I", None, ROLES[state], "", ""))

        for (role, text, kind, _), fault, letters in zip(rows, faults, solve(kinds, first, last)):
            for _ in letters[:-1]:
                insert()
            op = letters[-1]
            if op != "D":
                state = kept(kind % 4, state) if op == "K" else INSERTED[state]
            out.append((op, role, ROLES[state] if op == "R" else None if op == "D" else role, text if op != "D" else None, FAULTS[fault]))
        for _ in TAIL[last][1] if final else "":
            insert()
        columns = list(zip(*out))
        arrays = [pa.array([conv.as_py()] * len(out), conv.type), pa.array([piece] * len(out), pa.int64()), pa.array(range(len(out)), pa.int32()), *(pa.array(c, pa.string()) for c in columns)]
        return pa.RecordBatch.from_arrays(arrays, ["conv", *EDIT.names])

    piece, conv, rows, head = None, None, [], None
    for b in batches:
        at = {n: k for k, n in enumerate(names)}
        column = {n: b.column(at[n]).to_pylist() for n in ("piece", "place", "role", "kind", "fault", "text", "kinds", "faults", "first", "last", "ends")}
        for k in range(b.num_rows):
            if column["piece"][k] != piece:
                if rows:
                    yield done(conv, rows, head)
                piece, conv, rows, head = column["piece"][k], b.column(at["conv"])[k], [], None
            if column["place"][k] < 0:
                head = tuple(column[n][k] for n in ("kinds", "faults", "first", "last", "ends"))
            else:
                rows.append(tuple(column[n][k] for n in ("role", "text", "kind", "fault")))
    if rows:
        yield done(conv, rows, head)


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, piece, place, op, was, role, text, fault): every edit of every conversation, in the order of piece and place.

    ``op`` is K (kept), R (``role`` is new), D (``role`` and ``text`` are null) or I (inserted; ``was`` is null); ``fault``
    is blank, duplicate, truncated or empty. A conversation's rows are taken by turn (nulls first), then role and text.
    Null roles and texts count as one space, a null id is a conversation, too; a role is what its first letter says,
    and a row whose role has another one, or none, cannot be kept as it is. Repeated rows are duplicates of the first;
    an empty table gives no rows; other columns are ignored. The result is a table in the shared folder.
    """
    col = lambda c: F.col(f"`{c}`")
    space = lambda c: F.coalesce(col(c).cast("string"), F.lit(" "))
    cut = _pieces(rows.select(col(conv_col).alias("conv"), col(turn_col).alias("turn"), space(role_col).alias("role"), space(text_col).alias("text")))
    heads = _crossings(cut)
    plain = "binary,binary,int,int,boolean".split(",")
    nothing = [F.lit(None).cast(t).alias(n) for n, t in zip(("kinds", "faults", "first", "last", "ends"), plain)]
    body = cut.select("conv", "piece", "place", "kind", "fault", "role", "text", *nothing)
    head = heads.select("conv", "piece", F.lit(-1).alias("place"), F.lit(None).cast("int").alias("kind"), F.lit(None).cast("int").alias("fault"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), "kinds", "faults", "first", "last", "ends")
    both = body.union(head)
    lined = both.repartition("piece").sortWithinPartitions("piece", "place")
    names = lined.columns
    kind = cut.schema["conv"].dataType.simpleString()
    out = materialise(map_arrow(lined, lambda batches: _edits(batches, names), f"conv {kind}, piece long, place int, op string, was string, role string, text string, fault string"))
    forget(cut, heads)
    return out


def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) damaged as the query's contract says."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    text = F.when(draw == 1, "").when(draw == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    marked = rows.select("conv_id", "turn", F.when(draw == 4, "user").otherwise(space("role")).alias("role"), text.alias("text"), draw.alias("draw")).filter("draw <> 0")
    times = F.when(F.col("draw") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return marked.withColumn("_copy", F.explode(times)).select("conv_id", "turn", "role", "text")


def _summaries(batches) -> Iterator[pa.RecordBatch]:
    """Edits sorted by conversation, piece and place: a row for each conversation, read as a stream."""
    conv, n, audit, sha, before, lines = None, None, [], None, None, 0

    def done() -> pa.RecordBatch:
        values = [n["blank"], n["duplicate"], n["truncated"], n["illegal"], n["cost"]]
        arrays = [pa.array([conv.as_py()], conv.type), *(pa.array([v], pa.int64()) for v in values), pa.array(["".join(audit)]), pa.array([sha.hexdigest()])]
        return pa.RecordBatch.from_arrays(arrays, ["conv", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"])

    for b in batches:
        convs = b.column(0)
        for k, (op, was, role, text, fault) in enumerate(zip(*(b.column(j).to_pylist() for j in range(1, 6)))):
            if n is None or convs[k].as_py() != conv.as_py():
                if n is not None:
                    yield done()
                conv, n, audit, sha, before, lines = convs[k], dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost"), 0), [], hashlib.sha256(), None, 0
            audit.append(op)
            n["cost"] += {"K": 0, "R": 3, "D": 4, "I": 3}[op] + (3 if fault == "truncated" and op != "D" else 0)
            if fault:
                n[fault] += 1
            if op != "I":
                if before is not None and before + was[:1] not in LEGAL:
                    n["illegal"] += 1
                before = was[:1]
            if op != "D":
                sha.update(f"{chr(10) if lines else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
                lines += 1
    if n is not None:
        yield done()


def digest(rows: DataFrame) -> DataFrame:
    """The query's rows. A conversation's audit and hash are one value each, so one task reads its edits, as a stream."""
    hurt = damage(rows)
    edits = repair(hurt)
    kind = edits.schema["conv"].dataType.simpleString()
    lined = edits.repartition("conv").sortWithinPartitions("conv", "piece", "place").select("conv", "op", "was", "role", "text", "fault")
    sums = map_arrow(lined, _summaries, f"conv {kind}, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")
    turns = hurt.groupBy("conv_id", "turn").agg(F.lit(1).alias("one")).groupBy(F.col("conv_id").alias("_of")).agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))
    every = rows.select("conv_id").distinct()
    out = every.join(turns, F.col("conv_id").eqNullSafe(F.col("_of")), "left").join(sums, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    counts = map(zero, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"))
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


SQL = r"""
WITH RECURSIVE drawn AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, (4294967295 - list_reduce(list_concat([4294967295::BIGINT],
      list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT)),
      lambda c, b: list_reduce(list_concat([xor(c, b)], list_transform(range(8), lambda z: z * 0)), lambda x, y: xor(x >> 1, 3988292384 * (x & 1) + y)))) % 20 AS draw
  FROM conversations
), hurt AS (
  SELECT conv_id, turn, CASE draw WHEN 4 THEN 'user' ELSE role END AS role, CASE draw WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE draw WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM drawn
), rows AS (
  SELECT *, role[1] AS initial, row_number() OVER line AS nth, count(*) OVER (PARTITION BY conv_id) AS n, lag(role[1]) OVER line AS before,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM hurt WINDOW line AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)
), faults AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN bare[-1] NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM rows
), w AS (
  SELECT conv_id, n + 1 AS nth, {'c': 0::BIGINT, 'a': '', 't': ''} AS w0, {'c': 6::BIGINT, 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'} AS w1,
         {'c': 3::BIGINT, 'a': 'I', 't': chr(10) || 'assistant:'} AS w2, {'c': 0::BIGINT, 'a': '', 't': ''} AS w3
  FROM faults WHERE nth = 1
  UNION ALL
  SELECT conv_id, nth,
         list_min([r0, {'c': r2.c + 3, 'a': 'I' || r2.a, 't': chr(10) || 'user:' || r2.t}, {'c': r3.c + 6, 'a': 'II' || r3.a, 't': chr(10) || 'user:' || chr(10) || 'assistant:' || r3.t}]),
         list_min([r1, {'c': r2.c + 3, 'a': 'I' || r2.a, 't': chr(10) || 'user:' || r2.t}, {'c': r3.c + 6, 'a': 'II' || r3.a, 't': chr(10) || 'user:' || chr(10) || 'assistant:' || r3.t}]),
         list_min([r2, {'c': r3.c + 3, 'a': 'I' || r3.a, 't': chr(10) || 'assistant:' || r3.t}]),
         list_min([r3, {'c': r2.c + 3, 'a': 'I' || r2.a, 't': chr(10) || 'user:' || r2.t}])
  FROM (
    SELECT f.conv_id, f.nth,
           list_min(list_filter([d0, {'c': u.c + 3, 'a': 'R' || u.a, 't': chr(10) || 'user:' || text || u.t}, k0], lambda x: x IS NOT NULL AND (NOT gone OR x.a[1] = 'D'))) AS r0,
           list_min(list_filter([d1, {'c': u.c + 3, 'a': 'R' || u.a, 't': chr(10) || 'user:' || text || u.t}, k1], lambda x: x IS NOT NULL AND (NOT gone OR x.a[1] = 'D'))) AS r1,
           list_min(list_filter([d2, {'c': v.c + 3, 'a': 'R' || v.a, 't': chr(10) || 'assistant:' || text || v.t}, k2], lambda x: x IS NOT NULL AND (NOT gone OR x.a[1] = 'D'))) AS r2,
           list_min(list_filter([d3, {'c': u.c + 3, 'a': 'R' || u.a, 't': chr(10) || 'user:' || text || u.t}, k1], lambda x: x IS NOT NULL AND (NOT gone OR x.a[1] = 'D'))) AS r3
    FROM (
      SELECT f.*, fault IN ('blank', 'duplicate') AS gone,
             {'c': w0.c + 4, 'a': 'D' || w0.a, 't': w0.t} AS d0, {'c': w1.c + 4, 'a': 'D' || w1.a, 't': w1.t} AS d1,
             {'c': w2.c + 4, 'a': 'D' || w2.a, 't': w2.t} AS d2, {'c': w3.c + 4, 'a': 'D' || w3.a, 't': w3.t} AS d3,
             {'c': w2.c + e, 'a': w2.a, 't': w2.t} AS u, {'c': w3.c + e, 'a': w3.a, 't': w3.t} AS v,
             CASE initial WHEN 's' THEN {'c': w1.c + e, 'a': 'K' || w1.a, 't': chr(10) || role || ':' || text || w1.t} WHEN 'u' THEN {'c': w2.c + e, 'a': 'K' || w2.a, 't': chr(10) || role || ':' || text || w2.t} END AS k0,
             CASE initial WHEN 'u' THEN {'c': w2.c + e, 'a': 'K' || w2.a, 't': chr(10) || role || ':' || text || w2.t} END AS k1,
             CASE initial WHEN 'a' THEN {'c': w3.c + e, 'a': 'K' || w3.a, 't': chr(10) || role || ':' || text || w3.t} END AS k2
      FROM (SELECT faults.*, CASE fault WHEN 'truncated' THEN 3 ELSE 0 END AS e, w0, w1, w2, w3 FROM w JOIN faults ON faults.conv_id IS NOT DISTINCT FROM w.conv_id AND faults.nth = w.nth - 1) AS f
    ) AS f
  ) AS f
), sums AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(w0.c, 0) AS cost, coalesce(w0.a, '') AS audit, sha256(coalesce(w0.t[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS o LEFT JOIN sums ON sums.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN w ON w.conv_id IS NOT DISTINCT FROM o.conv_id AND w.nth = 1
"""

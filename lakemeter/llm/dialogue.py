"""Repair of the structure of conversations by cheapest edits (operator 13).

The rows of a conversation become a lattice: a node is (rows read, state of the form ``(s?(ua)+)?``), an
edge is an edit.  Keep costs 0, Rerole (to user or assistant, whichever the state asks for) 2, Delete 3,
Insert (an empty user or assistant row) 2; a truncated row that stays adds 1; blank and repeated rows must go.
``cheapest`` searches it from both ends: a forward and a reverse heap meet, both go on until no path of the
same cost can be open, and of all crossings the least concatenated audit wins.  Of two paths of one cost to one
node neither audit begins the other (inserts cost), so the least audit of a half is part of the least whole.

Long conversations: rows are range-partitioned by (conversation, turn), so one conversation may span many
tasks, and each task cuts its stretch into blocks of ``size`` rows.  A block is summed up by the costs
between its states and the order of their audits; summaries are combined for each partition and then for each
conversation (both bounded: blocks of a partition, partitions of the table), and the chosen states go
back to the blocks.  Texts take no part in this: rows carry a digest of role and text, and the texts are joined
to the rows that stay.  Rows equal in conversation, turn, role and text are one row with a count.  Only the
audit and the digest of a repaired conversation are made by one task, which reads its rows as a stream.

Cases: a null role, text, conversation or turn is one space wherever it is written out, null turns come first
and are no turns for the gaps; rows of one turn follow by role, then by a digest of the text; an empty role has no initial
and can't be kept as it is; rows without a conversation are one conversation (null); a conversation without
rows after damage has zeros, an empty audit and the digest of the empty text; texts of any length are joined whole;
an empty table gives no rows; columns other than the four are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemeter.session import Scratch, settle

#: rows of a block
BLOCK = 256
#: what may follow in each state of the form: nothing yet, after the system row, after a user, after an assistant
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: the role that an inserted or changed row gets in each state
ASKED = ("u", "u", "a", "u")
ENDS = (0, 3)
#: audit that completes the form from each state
CLOSING = ("", "II", "I", "")
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
NEVER = 1 << 60
SPACES = r"[\x20\x09-\x0D]"


# -- the lattice -------------------------------------------------------------------------------
def _ahead(rows: str, i: int, q: int, tail: bool) -> list[tuple[int, int, int, str]]:
    """(rows read, state, cost, letter) of the edits at a node.

    A row is a character: ``D`` must go, else its initial (``x``: another), a capital if truncated."""
    asked = NEXT[q][ASKED[q]]
    out = [(i, asked, 2, "I")] if i < len(rows) or tail else []
    if i < len(rows):
        row = rows[i]
        out.append((i + 1, q, 3, "D"))
        if row != "D":
            more = row.isupper()
            out.append((i + 1, asked, 2 + more, "R"))
            if row.lower() in NEXT[q]:
                out.append((i + 1, NEXT[q][row.lower()], 0 + more, "K"))
    return out


def _behind(rows: str, i: int, q: int, tail: bool) -> list[tuple[int, int, int, str]]:
    """The same edits by the node that they lead to."""
    out = []
    for p in range(4):
        for j, r, cost, letter in [*(_ahead(rows, i, p, tail) if i < len(rows) or tail else []), *(_ahead(rows, i - 1, p, tail) if i else [])]:
            if (j, r) == (i, q):
                out.append((i if letter == "I" else i - 1, p, cost, letter))
    return out


def cheapest(rows: str, start: int, goals: tuple[int, ...], tail: bool) -> tuple[int, str] | None:
    """(cost, audit) of the cheapest edits from ``start`` to one of ``goals``, least audit of equal ones.

    ``tail``: rows may be inserted after the last one."""
    n = len(rows)
    label: tuple[dict, dict] = ({(0, start): (0, "")}, {(n, q): (0, "") for q in goals})
    done: tuple[dict, dict] = ({}, {})
    # of equal costs the node with fewer rows to go back over comes first: free edits always move on by a row
    heaps = ([(0, 0, start)], [(0, 0, q) for q in sorted(goals)])
    best = min((label[0][x][0] + label[1][x][0] for x in label[0] if x in label[1]), default=NEVER)
    while heaps[0] and heaps[1] and heaps[0][0][0] + heaps[1][0][0] <= best:
        side = 0 if heaps[0][0][0] <= heaps[1][0][0] else 1
        cost, read, q = heappop(heaps[side])
        node = (read if side == 0 else n - read, q)
        if node in done[side] or label[side][node][0] != cost:
            continue
        audit = done[side][node] = label[side][node][1]
        for i, r, more, letter in (_ahead if side == 0 else _behind)(rows, *node, tail):
            to, found = (i, r), (cost + more, audit + letter if side == 0 else letter + audit)
            if to not in label[side] or found < label[side][to]:
                if to not in label[side] or found[0] < label[side][to][0]:
                    heappush(heaps[side], (found[0], i if side == 0 else n - i, r))
                label[side][to] = found
                if to in label[1 - side]:
                    best = min(best, found[0] + label[1 - side][to][0])
    if best == NEVER:
        return None
    for q in goals:  # the labels of the ends are final from the start
        done[1].setdefault((n, q), "")
    done[0].setdefault((0, start), "")
    crossings = [(label[0][x][0] + label[1][x][0], done[0][x] + done[1][x]) for x in done[0] if x in done[1]]
    for (i, q), audit in done[0].items():
        for j, r, more, letter in _ahead(rows, i, q, tail):
            if (j, r) in done[1]:
                crossings.append((label[0][i, q][0] + more + label[1][j, r][0], audit + letter + done[1][j, r]))
    return min(crossings)


@lru_cache(maxsize=50_000)
def repair_rows(rows: str) -> tuple[int, str]:
    """The edits of a whole conversation."""
    return cheapest(rows, 0, ENDS, True)


@lru_cache(maxsize=5_000)
def block_paths(rows: str) -> tuple[tuple[int, ...], tuple[int, ...], tuple[str, ...]]:
    """Costs between the states of a block (``NEVER``: no way), the order of the audits from one state, and the audits."""
    costs, audits = [], []
    for q in range(4):
        for r in range(4):
            found = cheapest(rows, q, (r,), False)
            costs.append(NEVER if found is None else found[0])
            audits.append("" if found is None else found[1])
    ranks = [sorted(audits[q * 4:q * 4 + 4]).index(a) for q in range(4) for a in audits[q * 4:q * 4 + 4]]
    return tuple(costs), tuple(ranks), tuple(audits)


def route(parts: list[tuple], start: int, last: int | None) -> list[tuple[int, int]] | None:
    """(state before, state after) of each (costs, ranks) in order, cheapest and of equal ones least in audit.

    ``last``: the state after the last part, or None for a whole conversation, completed at the end."""
    rest = [len(CLOSING[q]) * 2 for q in range(4)] if last is None else [0 if q == last else NEVER for q in range(4)]
    chosen = []
    for costs, ranks in reversed(parts):
        # audits that differ do so inside this part, so its order alone decides a tie
        step = [min((costs[q * 4 + r] + rest[r], ranks[q * 4 + r], r) for r in range(4)) for q in range(4)]
        chosen.append([x[2] for x in step])
        rest = [min(x[0], NEVER) for x in step]
    if rest[start] >= NEVER:
        return None
    out, q = [], start
    for step in reversed(chosen):
        out.append((q, step[q]))
        q = step[q]
    return out


def compose(parts: list[tuple]) -> tuple[list[int], list[int]]:
    """The costs and the order of audits of parts taken together."""
    costs, ranks = [], []
    for q in range(4):
        ways = [route(parts, q, r) for r in range(4)]
        keys = [[] if w is None else [p[1][a * 4 + b] for p, (a, b) in zip(parts, w)] for w in ways]
        costs += [NEVER if w is None else sum(p[0][a * 4 + b] for p, (a, b) in zip(parts, w)) for w in ways]
        ranks += [sorted(keys).index(k) for k in keys]
    return costs, ranks


# -- rows ----------------------------------------------------------------------------------------
def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies) after the damage that the checksum of ``conv_id:turn`` asks for."""
    written = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.pmod(F.crc32(F.concat(written("conv_id"), F.lit(":"), written("turn")).cast("binary")), F.lit(20))
    rows = conversations.select("conv_id", "turn", written("role").alias("role"), written("text").alias("text"), fault.alias("fault"))
    return rows.filter("fault != 0").select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("fault") == 3, 2).otherwise(1).alias("copies"))


def _marked(rows: DataFrame) -> DataFrame:
    """Rows with a digest of role and text."""
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return rows.withColumn("mark", F.unhex(F.sha2(whole.cast("binary"), 256)))


def _symbols(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, mark, symbol, kind, copies): one row for equal rows, without texts.

    ``kind`` is the row's first fault (blank, duplicate, truncated, or none); ``copies - 1`` more rows follow it,
    blank if it is, else duplicates."""
    solid = F.regexp_replace("text", SPACES, "")
    kind = F.when(solid == "", "blank").when(~F.substring(solid, -1, 1).isin(".", "!", "?"), "truncated").otherwise("none")
    once = _marked(rows).select("conv_id", "turn", "role", "mark", kind.alias("kind"), "copies")
    once = once.groupBy("conv_id", "turn", "role", "mark", "kind").agg(F.sum("copies").alias("copies"))
    first = once.groupBy(F.col("conv_id").alias("_conv"), F.col("mark").alias("_mark")).agg(
        F.max(F.col("turn").isNull()).alias("_null"), F.min("turn").alias("_turn"))
    seen = once.join(first, once["conv_id"].eqNullSafe(first["_conv"]) & (once["mark"] == first["_mark"]))
    is_first = F.col("turn").isNull() | (~F.col("_null") & (F.col("turn") == F.col("_turn")))
    kind = F.when((F.col("kind") != "blank") & ~is_first, "duplicate").otherwise(F.col("kind"))
    return seen.select("conv_id", "turn", "role", "mark", kind.alias("kind"), "copies")


SUMMARY = ("part int, seq long, rows string, first string, last string, illegal long, blank long, duplicate long, truncated long, "
           "least long, most long, turns long")


def _pair(a: str | None, b: str) -> int:
    return int(a is not None and a + b not in LEGAL)


class _Block:
    def __init__(self, conv):
        self.conv, self.rows, self.kept = conv, [], []
        self.first = self.last = self.least = self.most = None
        self.illegal = self.turns = 0
        self.count = {"blank": 0, "duplicate": 0, "truncated": 0, "none": 0}

    def add(self, turn, role: str, kind: str, mark: bytes) -> None:
        initial = role[:1]
        self.illegal += _pair(self.last, initial)
        if self.first is None:
            self.first = initial
        self.last = initial
        if turn is not None:
            self.least = turn if self.least is None else self.least
            self.turns += turn != self.most
            self.most = turn
        self.count[kind] += 1
        if kind in ("blank", "duplicate"):
            self.rows.append("D")
        else:
            symbol = initial if initial in ("s", "u", "a") else "x"
            self.rows.append(symbol.upper() if kind == "truncated" else symbol)
            self.kept.append({"turn": turn, "mark": mark})

    def row(self, part: int, seq: int) -> dict:
        return {"conv_id": self.conv, "part": part, "seq": seq, "rows": "".join(self.rows), "first": self.first, "last": self.last,
                "illegal": self.illegal, **{k: self.count[k] for k in ("blank", "duplicate", "truncated")},
                "least": self.least, "most": self.most, "turns": self.turns, "kept": self.kept}


def blocks(symbols: DataFrame, size: int = BLOCK) -> DataFrame:
    """Blocks of consecutive rows of one conversation, in order by (part, seq), with the marks of rows that may stay."""
    kind = symbols.schema["conv_id"].dataType.simpleString()
    turn = symbols.schema["turn"].dataType.simpleString()
    schema = f"conv_id {kind}, {SUMMARY}, kept array<struct<turn:{turn},mark:binary>>"
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("mark")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        seq, block, out = 0, None, []
        for batch in batches:
            for conv, t, role, mark, kind_, copies in zip(*(batch.column(i).to_pylist() for i in range(6))):
                for k in range(copies):
                    if block is None or block.conv != conv or len(block.rows) >= size:
                        if block is not None:
                            out.append(block.row(part, seq))
                            seq += 1
                        block = _Block(conv)
                    block.add(t, role, kind_ if not k or kind_ == "blank" else "duplicate", mark)
                    if len(out) >= 1_000:
                        yield pa.RecordBatch.from_pylist(out, schema=arrow)
                        out = []
        if block is not None:
            out.append(block.row(part, seq))
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    arrow = _arrow(symbols.sparkSession, schema)
    ranged = symbols.select("conv_id", "turn", "role", "mark", "kind", "copies").repartitionByRange(*order).sortWithinPartitions(*order)
    return ranged.mapInArrow(run, schema)


def _arrow(spark, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


# -- combination -----------------------------------------------------------------------------------
def _fold(parts: list[dict]) -> dict:
    """The summary of consecutive parts; counts add up, and neighbours meet at the seams."""
    out = {k: parts[0][k] for k in ("first", "last", "illegal", "blank", "duplicate", "truncated", "least", "most", "turns")}
    for p in parts[1:]:
        out["illegal"] += p["illegal"] + _pair(out["last"], p["first"])
        out["turns"] += p["turns"] - (p["least"] is not None and p["least"] == out["most"])
        out["least"] = p["least"] if out["least"] is None else out["least"]
        out["most"] = out["most"] if p["most"] is None else p["most"]
        out["last"] = p["last"]
        for k in ("blank", "duplicate", "truncated"):
            out[k] += p[k]
    return out


def _gaps(s: dict) -> int:
    return 0 if s["least"] is None else min(s["most"] - s["least"] + 1 - s["turns"], 2 ** 63 - 1)


REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"


def _whole(blocks_: DataFrame, kind: str) -> DataFrame:
    """Reports and audits of conversations of one block."""
    spark = blocks_.sparkSession
    schema = f"conv_id {kind}, part int, seq long, {REPORT}, audit string"
    arrow = _arrow(spark, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for b in batch.to_pylist():
                cost, audit = repair_rows(b["rows"])
                out.append({**{k: b[k] for k in ("conv_id", "part", "seq", "blank", "duplicate", "truncated", "illegal")},
                            "gaps": _gaps(b), "cost": cost, "audit": audit})
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return blocks_.mapInArrow(run, schema)


def _spread(blocks_: DataFrame, kind: str, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Reports and audits of conversations of several blocks: blocks -> partitions -> conversation and back."""
    spark = blocks_.sparkSession
    paths = "costs array<long>, ranks array<int>"
    block_schema = f"conv_id {kind}, {SUMMARY}, {paths}"
    part_schema = block_schema.replace("rows string, ", "")
    total_schema = f"conv_id {kind}, part int, begin int, end int, {REPORT}"
    audit_schema = f"conv_id {kind}, part int, seq long, audit string, state int"
    arrow = {x: _arrow(spark, x) for x in (block_schema, part_schema, total_schema, audit_schema)}

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for b in batch.to_pylist():
                costs, ranks, _ = block_paths(b["rows"])
                out.append({**b, "costs": list(costs), "ranks": list(ranks)})
            yield pa.RecordBatch.from_pylist(out, schema=arrow[block_schema])

    def one_part(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda b: b["seq"])
        costs, ranks = compose([(b["costs"], b["ranks"]) for b in rows])
        return pa.Table.from_pylist([{"conv_id": rows[0]["conv_id"], "part": rows[0]["part"], "seq": 0, **_fold(rows), "costs": costs, "ranks": ranks}],
                                    schema=arrow[part_schema])

    def conversation(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda b: b["part"])
        way = route([(b["costs"], b["ranks"]) for b in rows], 0, None)
        s = _fold(rows)
        cost = sum(b["costs"][q * 4 + r] for b, (q, r) in zip(rows, way)) + 2 * len(CLOSING[way[-1][1]])
        report = {"gaps": _gaps(s), "cost": cost, **{k: s[k] for k in ("blank", "duplicate", "truncated", "illegal")}}
        last = len(rows) - 1
        return pa.Table.from_pylist([{"conv_id": b["conv_id"], "part": b["part"], "begin": q, "end": -1 if i == last else r, **report}
                                     for i, (b, (q, r)) in enumerate(zip(rows, way))], schema=arrow[total_schema])

    def back(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda b: b["seq"])
        end = None if rows[0]["end"] < 0 else rows[0]["end"]
        way = route([(b["costs"], b["ranks"]) for b in rows], rows[0]["begin"], end)
        out = []
        for i, (b, (q, r)) in enumerate(zip(rows, way)):
            audit = block_paths(b["rows"])[2][q * 4 + r]
            out.append({"conv_id": b["conv_id"], "part": b["part"], "seq": b["seq"], "state": q,
                        "audit": audit + (CLOSING[r] if end is None and i == len(rows) - 1 else "")})
        return pa.Table.from_pylist(out, schema=arrow[audit_schema])

    summed = scratch.save(blocks_.mapInArrow(sums, block_schema))
    parts = summed.groupBy("conv_id", "part").applyInArrow(one_part, part_schema)
    totals = scratch.save(parts.groupBy("conv_id").applyInArrow(conversation, total_schema))
    ends = totals.select(F.col("conv_id").alias("_conv"), F.col("part").alias("_part"), "begin", "end")
    routed = summed.join(ends, summed["conv_id"].eqNullSafe(ends["_conv"]) & (summed["part"] == ends["_part"])).drop("_conv", "_part")
    audits = scratch.save(routed.groupBy("conv_id", "part").applyInArrow(back, audit_schema))
    joined = audits.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "seq", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    report = totals.select("conv_id", *[x.split()[0] for x in REPORT.split(", ")]).dropDuplicates(["conv_id"])
    other = joined.select(F.col("conv_id").alias("_conv"), "audit")
    return report.join(other, report["conv_id"].eqNullSafe(other["_conv"])).drop("_conv"), audits


def _placed(blocks_: DataFrame, audits: DataFrame, kind: str) -> DataFrame:
    """(conv_id, part, seq, place, role, turn, mark): the rows of repaired conversations; ``role`` is null for kept ones."""
    turn = blocks_.schema["kept"].dataType.elementType["turn"].dataType.simpleString()
    schema = f"conv_id {kind}, part int, seq long, place int, role string, turn {turn}, mark binary"
    arrow = _arrow(blocks_.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                out = []
                for b in batch.slice(at, 500).to_pylist():
                    q, kept, row = b["state"], iter(b["kept"]), iter(b["rows"])
                    for place, letter in enumerate(b["audit"]):
                        symbol = None if letter == "I" else next(row)
                        ref = {"turn": None, "mark": None} if symbol in (None, "D") else next(kept)
                        if letter == "D":
                            continue
                        role = None if letter == "K" else ROLES[ASKED[q]]
                        q = NEXT[q][symbol.lower() if letter == "K" else ASKED[q]]
                        out.append({"conv_id": b["conv_id"], "part": b["part"], "seq": b["seq"], "place": place, "role": role, **ref})
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=arrow)

    key = audits.select(F.col("conv_id").alias("_conv"), F.col("part").alias("_part"), F.col("seq").alias("_seq"), "audit", "state")
    # (part, seq) names a block in the whole table
    both = blocks_.join(key, (blocks_["part"] == key["_part"]) & (blocks_["seq"] == key["_seq"]))
    return both.select("conv_id", "part", "seq", "rows", "kept", "audit", "state").mapInArrow(run, schema)


class Repair:
    """``report``: (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of conversations with rows;
    ``rows``: (conv_id, part, seq, place, role, text) of the repaired ones, in order by the middle three."""

    def __init__(self, report: DataFrame, rows: DataFrame):
        self.report, self.rows = report, rows


def repair(rows: DataFrame, scratch: Scratch, size: int = BLOCK) -> Repair:
    """The cheapest repair of conversations of (conv_id, turn, role, text, copies)."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    cut = scratch.save(blocks(_symbols(rows), size))
    light = cut.drop("kept")
    sizes = light.groupBy(F.col("conv_id").alias("_conv")).agg(F.count("*").alias("_blocks"))
    counted = scratch.save(light.join(sizes, light["conv_id"].eqNullSafe(sizes["_conv"])).drop("_conv"))
    done = scratch.save(_whole(counted.filter("_blocks = 1").drop("_blocks"), kind))
    audits = done.select("conv_id", "part", "seq", "audit", F.lit(0).alias("state"))
    report = done.drop("part", "seq")
    several = counted.filter("_blocks > 1").drop("_blocks")
    if not several.isEmpty():
        more, more_audits = _spread(several, kind, scratch)
        report, audits = report.unionByName(more), audits.unionByName(more_audits)
    placed = _placed(cut, audits, kind)
    texts = _marked(rows).select(F.col("conv_id").alias("_conv"), F.col("turn").alias("_turn"), F.col("mark").alias("_mark"),
                                 F.col("role").alias("_role"), "text").dropDuplicates(["_conv", "_turn", "_mark"])
    same = placed["conv_id"].eqNullSafe(texts["_conv"]) & placed["turn"].eqNullSafe(texts["_turn"]) & (placed["mark"] == texts["_mark"])
    kept = placed.join(texts, same, "left")
    return Repair(report, kept.select("conv_id", "part", "seq", "place", F.coalesce("role", "_role").alias("role"), F.coalesce("text", F.lit("")).alias("text")))


def digests(rows: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of ``repair``'s rows: one pass over sorted rows, a conversation as a stream."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, repaired_sha256 string"
    arrow = _arrow(rows.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = None, None
        for batch in batches:
            out = []
            for c, line in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                if state is None or c != conv:
                    if state is not None:
                        out.append({"conv_id": conv, "repaired_sha256": state.hexdigest()})
                    conv, state = c, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(line)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
        if state is not None:
            yield pa.RecordBatch.from_pylist([{"conv_id": conv, "repaired_sha256": state.hexdigest()}], schema=arrow)

    line = F.concat("role", F.lit(":"), "text").alias("line")
    ordered = rows.select("conv_id", line, "part", "seq", "place").repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq", "place")
    return ordered.select("conv_id", "line").mapInArrow(run, schema)


def report(conversations: DataFrame, rows: DataFrame | None = None, size: int = BLOCK) -> DataFrame:
    """A row for each conversation id of ``conversations``; ``rows``: what is to be repaired (default: their damaged rows)."""
    rows = damaged(conversations) if rows is None else rows
    with Scratch(conversations.sparkSession) as scratch:
        done = repair(rows, scratch, size)
        every = conversations.select("conv_id").distinct()
        part = done.report.withColumnRenamed("conv_id", "_conv")
        sha = digests(done.rows).select(F.col("conv_id").alias("_sha_conv"), "repaired_sha256")
        out = every.join(part, every["conv_id"].eqNullSafe(part["_conv"]), "left")
        out = out.join(sha, out["conv_id"].eqNullSafe(sha["_sha_conv"]), "left")
        zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
        return settle(out.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                                 F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256")))

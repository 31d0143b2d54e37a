"""Repair of conversation structure: the cheapest edits that turn the roles of a conversation into ``(s?(ua)+)?``.

A turn is kept (0), gets the role user or assistant (2) or is deleted (3, which blank and repeated turns must be); an empty turn of a user or
an assistant may be inserted anywhere (2); a truncated turn that is not deleted adds 1.  Of equal costs the edits whose initials
come first in ASCII are taken.

Conversations are cut into segments of at most ``SEGMENT`` successive turns.  Each is searched by depth-first branch-and-bound, once for
each pair of the states before and behind it (nothing yet, after s, after u, after a): an explicit stack, lower bounds of what is left
to pay (what a turn costs at least, and 2 for each of disjoint pairs of neighbours that cannot follow one another), the incumbent (cost,
audit), and for each node (turn, state) a table of the best prefix, which ends worse ones, until nothing open can be better.  As
the best prefix of a node is a prefix of the best whole, segments are joined in order by the best (cost, audit) for each state.  So a
conversation may hold any share of all turns: turns are sorted over the cluster, segments are solved side by side, and only
segments, a row each, meet by conversation.  The repaired turns of a conversation are written in order by one task, which holds
the audit and one batch of turns; the order is what its digest is of.

Defined results: a null role or text counts as one space; turns without a number come first; ties go by role, then text; turns equal in
all of these are repeated turns; a null conv_id is a conversation; a conversation whose turns all go has no repaired turn; an empty
table gives no rows.  Columns other than conv_id, turn, role and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flatspan.llm import unused
from flatspan.session import write_stage

SEGMENT = 64
#: Solutions that a task remembers, by segment and states.
REMEMBERED = 1 << 14
BLANKS = " \t\n\x0b\f\r"
BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"

#: States: nothing yet, after s, after u, after a.  What may follow, and what an insertion or a new role adds.
STATES = range(4)
FOLLOWS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ADDED = ("u", "u", "a", "u")
LEGAL = {"su", "ua", "au"}
DELETE, INSERT, RENAME, CUT = 3, 2, 2, 1

Solution = tuple[int, str]


# --- the search ------------------------------------------------------------------------------------


def lower_bounds(codes: str) -> list[int]:
    """What the turns from each one on cost at least.

    ``codes`` has a sign for each turn: x must go; else the initial s, u, a or o (another), a capital if it is truncated.  Beyond the least
    cost of each turn, two neighbours that cannot follow one another cost 2, as one of them is changed or something put
    between; pairs that share no turn add up.
    """
    least = {"x": DELETE, "o": RENAME, "O": RENAME + CUT, "S": CUT, "U": CUT, "A": CUT}
    bounds, own, one, two, after = [0], 0, 0, 0, ""
    for code in reversed(codes):
        own += least.get(code, 0)
        if code != "x":
            initial = code.lower()
            apart = after and initial != "o" and after != "o" and initial + after not in LEGAL
            one, two = max(one, two + INSERT) if apart else one, one
            after = initial
        bounds.append(own + one)
    return bounds[::-1]


def search(codes: str, entry: int, leave: int) -> Solution | None:
    """The least (cost, audit) from one state to another, or None where there is none."""
    bounds, n = lower_bounds(codes), len(codes)
    incumbent: Solution | None = None
    table: dict[tuple[int, int], Solution] = {(0, entry): (0, "")}
    stack = [(0, entry, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        if table[i, state] != (cost, audit):
            continue  # a better prefix has been found
        if incumbent is not None:
            hope = cost + bounds[i]
            if hope > incumbent[0] or hope == incumbent[0] and audit > incumbent[1][: len(audit)]:
                continue
        if i == n and state == leave and (incumbent is None or (cost, audit) < incumbent):
            incumbent = (cost, audit)
        steps = [(i, FOLLOWS[state][ADDED[state]], cost + INSERT, audit + "I")]
        if i < n:
            code = codes[i]
            steps.append((i + 1, state, cost + DELETE, audit + "D"))
            if code != "x":
                cut, kept = CUT if code.isupper() else 0, FOLLOWS[state].get(code.lower())
                if kept is not None:
                    steps.append((i + 1, kept, cost + cut, audit + "K"))
                if code.lower() != ADDED[state]:
                    steps.append((i + 1, FOLLOWS[state][ADDED[state]], cost + RENAME + cut, audit + "R"))
        open_ = []
        for step in steps:
            node, prefix = step[:2], step[2:]
            if incumbent is not None and prefix[0] + bounds[step[0]] > incumbent[0]:
                continue
            if node not in table or prefix < table[node]:
                table[node] = prefix
                open_.append(step)
        open_.sort(key=lambda x: (x[2] + bounds[x[0]], x[3]), reverse=True)
        stack += open_  # the most hopeful is looked at first
    return incumbent


def can_reach(entry: int, leave: int) -> bool:
    return leave >= entry if entry < 2 else leave >= 2


def solve_segment(codes: str, known: dict) -> list[tuple[int, int, int, str]]:
    """(entry, leave, cost, audit) for all pairs of states that edits can join."""
    if codes not in known:
        if len(known) >= REMEMBERED:
            known.clear()
        found = [(e, f, search(codes, e, f)) for e in STATES for f in STATES if can_reach(e, f)]
        known[codes] = [(e, f, *s) for e, f, s in found if s is not None]
    return known[codes]


def follow(prefixes: dict[int, Solution], table: list[dict]) -> dict[int, Solution]:
    """The best prefix for each state behind a segment, from those before it."""
    out: dict[int, Solution] = {}
    for x in table:
        before = prefixes.get(x["entry"])
        if before is not None:
            whole = (before[0] + x["cost"], before[1] + x["audit"])
            if x["leave"] not in out or whole < out[x["leave"]]:
                out[x["leave"]] = whole
    return out


# --- over the cluster ------------------------------------------------------------------------------


def ordered(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, fault, pos): the turns with their first fault, ``pos`` rising along each conversation."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), space("role"), space("text"))
    shown = F.rtrim("text", F.lit(BLANKS))
    blank, ended = shown == "", F.right(shown, F.lit(1)).isin(".", "!", "?")
    rows = rows.withColumn("key", F.unhex(F.sha2("text", 256))).withColumns({"blank": blank, "ended": ended, "at": F.monotonically_increasing_id()})
    rows = write_stage(rows, "repair-turns")
    first = rows.where(~F.col("blank")).groupBy("conv_id", "role", "key").agg(F.min(F.struct("turn", "at")).alias("first"), F.count("*").alias("n"))
    first = first.where("n > 1").select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("key").alias("k"), F.col("first.at").alias("first"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("key") == F.col("k"))
    rows = rows.join(first, same, "left")
    fault = F.when(F.col("blank"), BLANK).when(F.col("first") != F.col("at"), DUPLICATE).when(~F.col("ended"), TRUNCATED)
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.xxhash64("key"), F.col("at")]
    rows = rows.withColumn("fault", fault).repartitionByRange(*order).sortWithinPartitions(*order)
    return write_stage(rows.select("conv_id", "turn", "role", "text", "fault", F.monotonically_increasing_id().alias("pos")), "repair-ordered")


def initial(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first.isin("s", "u", "a"), first).otherwise("o")


def segments(rows: DataFrame) -> DataFrame:
    """(conv_id, block, initials, codes): successive turns of a conversation, at most ``SEGMENT`` of them."""
    first = initial(F.col("role"))
    code = F.when(F.col("fault").isin(BLANK, DUPLICATE), "x").when(F.col("fault") == TRUNCATED, F.upper(first)).otherwise(first)
    turn = F.struct("pos", first.alias("initial"), code.alias("code"))
    parts = rows.groupBy("conv_id", F.expr(f"pos div {SEGMENT}").alias("block")).agg(F.sort_array(F.collect_list(turn)).alias("l"))  # SEGMENT at most
    return parts.select("conv_id", "block", F.array_join("l.initial", "").alias("initials"), F.array_join("l.code", "").alias("codes"))


def repair_plans(rows: DataFrame) -> DataFrame:
    """(conv_id, cost, audit, illegal) of every conversation of ``rows`` (as ``ordered`` gives them)."""
    names = ["block", "illegal", "ends", "table"]
    entry = pa.struct([("entry", pa.int32()), ("leave", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            illegal, ends, tables = [], [], []
            for initials, codes in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                illegal.append(sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False)))
                ends.append(initials[0] + initials[-1])
                tables.append([dict(zip(("entry", "leave", "cost", "audit"), x, strict=True)) for x in solve_segment(codes, known)])
            columns = [batch.column(0), batch.column(1), pa.array(illegal, pa.int64()), pa.array(ends, pa.string()), pa.array(tables, pa.list_(entry))]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", *names])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", kind), ("cost", pa.int64()), ("audit", pa.string()), ("illegal", pa.int64())])
        done, now, prefixes, illegal, last = [], None, None, 0, ""

        def finish() -> None:
            cost, audit = min(s for state, s in prefixes.items() if state in (0, 3))
            done.append({"conv_id": now, "cost": cost, "audit": audit, "illegal": illegal})

        for batch in batches:
            for conv, _, inside, ends, table in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if prefixes is not None and conv != now:
                    finish()
                    prefixes = None
                if prefixes is None:
                    now, prefixes, illegal, last = conv, {0: (0, "")}, 0, ""
                illegal += inside + (last != "" and last + ends[0] not in LEGAL)
                prefixes, last = follow(prefixes, table), ends[1]
            if len(done) >= 4096:
                yield pa.RecordBatch.from_pylist(done, schema)
                done.clear()
        if prefixes is not None:
            finish()
        yield pa.RecordBatch.from_pylist(done, schema)

    conv = rows.schema["conv_id"].dataType.simpleString()
    solved = segments(rows).mapInArrow(run, f"conv_id {conv}, block long, illegal long, ends string, table array<struct<entry:int,leave:int,cost:bigint,audit:string>>")
    kind = arrow_type(conv)
    return solved.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(join, f"conv_id {conv}, cost long, audit string, illegal long")


def arrow_type(name: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[name]


def repaired(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """(conv_id, place, role, text, edit): the conversations of ``rows`` after the edits of ``plans``, sorted within each task, whole
    conversations in one."""
    conv = rows.schema["conv_id"].dataType.simpleString()
    kind = arrow_type(conv)
    schema = pa.schema([("conv_id", kind), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])
    audits = plans.select("conv_id", F.lit(-1).cast("long").alias("pos"), F.lit(None).cast("string").alias("role"), F.col("audit").alias("text"))
    both = audits.unionByName(rows.select("conv_id", "pos", "role", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, conv, audit, at, state, place = [], None, "", 0, 0, 0

        def add(role: str | None, text: str, edit: str) -> None:
            nonlocal state, place
            if role is None:
                role = "user" if ADDED[state] == "u" else "assistant"
            out.append((conv, place, role, text, edit))
            state, place = FOLLOWS[state][role[0]], place + 1

        def insert() -> None:
            nonlocal at
            while at < len(audit) and audit[at] == "I":
                add(None, "", "I")
                at += 1

        for batch in batches:
            for now, pos, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if pos == -1:
                    insert()  # what is left of the conversation before
                    conv, audit, at, state, place = now, text, 0, 0, 0
                    continue
                insert()
                edit = audit[at]
                at += 1
                if edit != "D":
                    add(role if edit == "K" else None, text, edit)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
                out.clear()
        insert()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    dealt = both.repartition("conv_id").sortWithinPartitions("conv_id", "pos")
    return dealt.mapInArrow(run, f"conv_id {conv}, place long, role string, text string, edit string")


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, sha256): of the lines ``role:text`` of each conversation of ``turns``, as ``repaired`` gives them."""
    conv = turns.schema["conv_id"].dataType.simpleString()
    schema = pa.schema([("conv_id", arrow_type(conv)), ("sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, done = None, None, []
        for batch in batches:
            for conv, place, role, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if place == 0:
                    if state is not None:
                        done.append({"conv_id": now, "sha256": state.hexdigest()})
                    now, state = conv, hashlib.sha256()
                state.update(f"{chr(10) if place else ''}{role}:{text}".encode())
            if len(done) >= 4096:
                yield pa.RecordBatch.from_pylist(done, schema)
                done = []
        if state is not None:
            done.append({"conv_id": now, "sha256": state.hexdigest()})
        yield pa.RecordBatch.from_pylist(done, schema)

    return turns.mapInArrow(run, f"conv_id {conv}, sha256 string")


def damaged(turns: DataFrame) -> DataFrame:
    """The turns with the damage that the CRC of ``conv_id:turn`` chooses: 0 drops, 1 empties, 2 takes the full stops, 3 repeats, 4 makes a user."""
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.encode(F.concat(word("conv_id"), F.lit(":"), word("turn")), "utf-8")) % 20
    name = unused(turns, "damage")
    rows = turns.withColumn(name, kind).where(F.col(name) != 0)
    text = F.when(F.col(name) == 1, "").when(F.col(name) == 2, F.regexp_replace(word("text"), "[.!?]", "")).otherwise(word("text"))
    role = F.when(F.col(name) == 4, "user").otherwise(word("role"))
    copies = F.explode(F.array_repeat(F.lit(1), F.when(F.col(name) == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias(name)).drop(name)


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = ordered(damaged(turns))
    plans = write_stage(repair_plans(rows), "repair-plans")
    shas = digests(repaired(rows, plans))
    first, last, different = F.min("turn"), F.max("turn"), F.count_distinct("turn")
    stats = rows.groupBy("conv_id").agg(
        F.coalesce(last - first + 1 - different, F.lit(0)).alias("gaps"),
        *[F.count_if(F.coalesce(F.col("fault") == f, F.lit(False))).alias(f) for f in (BLANK, DUPLICATE, TRUNCATED)],
    )
    # One row a conversation in each part, put together by one shuffle.
    parts = turns.select("conv_id").unionByName(stats, True).unionByName(plans, True).unionByName(shas.withColumnRenamed("sha256", "repaired_sha256"), True)
    nothing = hashlib.sha256().hexdigest()
    count = lambda c: F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c)
    return parts.groupBy("conv_id").agg(
        *[count(c) for c in ("gaps", BLANK, DUPLICATE, TRUNCATED, "illegal", "cost")],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(nothing)).alias("repaired_sha256"),
    )

"""Conversation repair: cheapest edits to a well-formed order of roles, by a Viterbi search in parallel chunks.

A chunk's costs depend on those at its right end only through their differences, so chunks start from a
speculative vector of costs and are mended where the true one turns out to be another.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import WORD_PATTERN, partitions, read_table, running_totals, store

# Rows of a chunk; a conversation has at most as many chunks as its audit, one value, has characters by this.
CHUNK_ROWS = 4096
# Fix-up passes before the chunks of what is left are joined by their whole cost matrices.
FIX_UPS = 4

KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 1, 2, 5, 5

# States: nothing kept yet, after a leading system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
# Where an inserted or reroled turn leads: only an assistant turn may follow a user turn.
NEXT = (USER, USER, ASSISTANT, USER)
# Initials by number, and where a kept turn leads from each state (None: not allowed).
INITIALS = "sua"
OTHER = 3
KEPT = ((SYSTEM, None, None, None), (USER, USER, None, USER), (None, None, ASSISTANT, None), (None,) * 4)
# Symbol of a row: its initial's number plus 4 times its kind.
FREE, TRUNCATED, FORCED = range(3)
FIRST_SYMBOL = 48
LEGAL_PAIRS = {(0, 1), (1, 2), (2, 1)}

Vector = tuple[int, int, int, int]
EDITS = "DKR"


def with_inserts(costs: list[int]) -> Vector:
    """Costs where up to two turns may be inserted first; more only lead back."""
    return tuple(min(costs[s], INSERT + costs[NEXT[s]], 2 * INSERT + costs[NEXT[NEXT[s]]]) for s in STATES)


UNREACHABLE = 1 << 40
# Cost of ending in each state.
END = with_inserts([0, UNREACHABLE, UNREACHABLE, 0])


def before(symbol: int, after: Vector) -> Vector:
    """Costs to go before a row, from those after it."""
    initial, kind = symbol % 4, symbol // 4
    if kind == FORCED:
        return tuple(c + DELETE for c in after)
    extra = UNFINISHED if kind == TRUNCATED else 0
    costs = []
    for s in STATES:
        options = [DELETE + after[s], REROLE + extra + after[NEXT[s]]]
        if KEPT[initial][s] is not None:
            options.append(KEEP + extra + after[KEPT[initial][s]])
        costs.append(min(options))
    return with_inserts(costs)


def level(costs: Vector) -> tuple[Vector, int]:
    """The vector without its constant, and the constant."""
    return tuple(c - costs[ASSISTANT] for c in costs), costs[ASSISTANT]


class Steps:
    """Steps between vectors without their constants; there are few, so each is worked out once."""

    def __init__(self):
        self.back: dict[tuple[int, Vector], tuple[Vector, int]] = {}
        self.edits: dict[tuple[int, Vector, int], tuple[str, int]] = {}

    def step(self, symbol: int, after: Vector) -> tuple[Vector, int]:
        found = self.back.get((symbol, after))
        if found is None:
            found = self.back[symbol, after] = level(before(symbol, after))
        return found

    def edit(self, symbol: int, after: Vector, state: int) -> tuple[str, int]:
        """Code of the ASCII-least cheapest edits that take in a row from ``state``, and the state behind them."""
        found = self.edits.get((symbol, after, state))
        if found is None:
            found = self.edits[symbol, after, state] = self._edit(symbol, after, state)
        return found

    def _edit(self, symbol: int, after: Vector, state: int) -> tuple[str, int]:
        costs = before(symbol, after)
        initial, kind = symbol % 4, symbol // 4
        extra = UNFINISHED if kind == TRUNCATED else 0
        at, inserted = state, 0
        while True:
            kept = KEPT[initial][at]
            if costs[at] == DELETE + after[at]:
                return code(state, inserted, 0), at
            if costs[at] == INSERT + costs[NEXT[at]]:
                at, inserted = NEXT[at], inserted + 1
            elif kept is not None and costs[at] == KEEP + extra + after[kept]:
                return code(state, inserted, 1), kept
            else:
                return code(state, inserted, 2), NEXT[at]


def code(state: int, inserted: int, edit: int) -> str:
    """One character for what happens at a row: state before, turns inserted, edit of the row."""
    return chr(FIRST_SYMBOL + (state * 3 + inserted) * 3 + edit)


CODES = [(s, i, e) for s in STATES for i in range(3) for e in range(3)]


def inserted_roles(state: int, inserted: int) -> list[str]:
    roles = []
    for _ in range(inserted):
        roles.append("assistant" if state == USER else "user")
        state = NEXT[state]
    return roles


def new_role(state: int, inserted: int) -> str:
    """The role that a reroled turn gets."""
    for _ in range(inserted):
        state = NEXT[state]
    return "assistant" if state == USER else "user"


def pack(vector: Vector) -> bytes:
    """Differences are small: each state reaches each other by at most two inserts."""
    return bytes(c + 64 for c in vector)


def unpack(text: bytes) -> Vector:
    return tuple(c - 64 for c in text)


def backward(steps: Steps, symbols: bytes, right: Vector) -> tuple[list[Vector], int]:
    """Vector before each row, the one at the right end last, and the constant gathered on the way."""
    trail, constant, vector = [right], 0, right
    for symbol in reversed(symbols):
        vector, more = steps.step(symbol, vector)
        trail.append(vector)
        constant += more
    trail.reverse()
    return trail, constant


def mend(steps: Steps, symbols: bytes, trail: list[Vector], constant: int, right: Vector) -> tuple[list[Vector], int]:
    """The same from another right end; stops where the vectors differ only by a constant."""
    out, vector, gained = list(trail), right, 0
    out[-1] = right
    for i in range(len(symbols) - 1, -1, -1):
        old = steps.step(symbols[i], trail[i + 1])[1]
        vector, more = steps.step(symbols[i], vector)
        gained += more - old
        if vector == trail[i]:
            return out, constant + gained
        out[i] = vector
    return out, constant + gained


def forward(steps: Steps, symbols: bytes, trail: list[Vector], state: int) -> tuple[str, int]:
    """Edit codes of a chunk entered in ``state``, and the state it leaves."""
    codes = []
    for i, symbol in enumerate(symbols):
        found, state = steps.edit(symbol, trail[i + 1], state)
        codes.append(found)
    return "".join(codes), state


def symbols_of(text: str) -> bytes:
    return bytes(ord(c) - FIRST_SYMBOL for c in text)


def _trail_text(trail: list[Vector]) -> bytes:
    return b"".join(map(pack, trail))


def _trail(text: bytes) -> list[Vector]:
    return [unpack(text[i : i + 4]) for i in range(0, len(text), 4)]


CHUNK = "_conv string, chunk bigint, symbols string"
# used: vector assumed at the right end; found: vector at the left end
SOLVED = f"{CHUNK}, used binary, found binary, trail binary, constant bigint"


def _each_row(schema: str, work):
    """mapInArrow function: ``work(steps, row)`` returns the columns to add."""
    form = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches):
        steps = Steps()
        for batch in batches:
            rows = [row | work(steps, row) for row in batch.to_pylist()]
            yield pa.RecordBatch.from_pylist([{n: r[n] for n in form.names} for r in rows], schema=form)

    return run


def _solve(steps: Steps, row: dict) -> dict:
    trail, constant = backward(steps, symbols_of(row["symbols"]), level(END)[0])
    return {"used": pack(trail[-1]), "found": pack(trail[0]), "trail": _trail_text(trail), "constant": constant}


def _fix_up(steps: Steps, row: dict) -> dict:
    if row["wanted"] is None or row["wanted"] == row["used"]:
        return {}
    symbols, old = symbols_of(row["symbols"]), _trail(row["trail"])
    trail, constant = mend(steps, symbols, old, row["constant"], unpack(row["wanted"]))
    return {"used": row["wanted"], "found": pack(trail[0]), "trail": _trail_text(trail), "constant": constant}


def _matrix(steps: Steps, row: dict) -> dict:
    """Costs at the left end for each state being the only one at the right end."""
    columns = []
    for s in STATES:
        vector = tuple(0 if t == s else UNREACHABLE for t in STATES)
        for symbol in reversed(symbols_of(row["symbols"])):
            vector = tuple(min(c, UNREACHABLE) for c in before(symbol, vector))
        columns += vector
    return {"costs": columns}


def _exact_ends(chunks: pd.DataFrame) -> pd.DataFrame:
    """Right-end vectors of a conversation's chunks, from the last to the first."""
    chunks = chunks.sort_values("chunk", ascending=False)
    vector, wanted = END, []
    for costs in chunks["costs"]:
        vector = level(vector)[0]
        wanted.append(pack(vector))
        vector = tuple(min(vector[s] + int(costs[4 * s + t]) for s in STATES) for t in STATES)
    return pd.DataFrame({"_conv": chunks["_conv"], "chunk": chunks["chunk"], "wanted": wanted})


def settle(chunks: DataFrame, fix_ups: int = FIX_UPS) -> DataFrame:
    """Chunks with the cost vectors of the best edits of all that follows.

    Every chunk but a conversation's last starts from the vector of the end.  A pass mends all chunks whose
    right neighbour found another one, each up to where the vectors differ only by a constant; passes go on
    until none is left.  Chunks in which costs never come together (rows that are all deleted, say) would
    need a pass each, so after ``fix_ups`` passes the right ends follow from the chunks' cost matrices, of 16
    numbers a chunk, conversation by conversation.
    """
    solved = store(chunks.mapInArrow(_each_row(SOLVED, _solve), SOLVED), "turns-solved")
    for i in range(fix_ups + 1):
        right = solved.select("_conv", (F.col("chunk") - 1).alias("chunk"), F.col("found").alias("wanted"))
        joined = solved.join(right, ["_conv", "chunk"], "left")
        open_ = joined.where("wanted <> used")
        if open_.isEmpty():
            return solved
        if i == fix_ups:
            left = solved.join(open_.select("_conv").distinct(), "_conv", "left_semi")
            schema = "_conv string, chunk bigint, costs array<bigint>"
            costs = left.select("_conv", "chunk", "symbols").mapInArrow(_each_row(schema, _matrix), schema)
            ends = costs.groupBy("_conv").applyInPandas(_exact_ends, "_conv string, chunk bigint, wanted binary")
            joined = solved.join(ends, ["_conv", "chunk"], "left")
        solved = store(joined.mapInArrow(_each_row(SOLVED, _fix_up), SOLVED), "turns-mended")
    return solved


def _map_states(steps: Steps, row: dict) -> dict:
    symbols, trail = symbols_of(row["symbols"]), _trail(row["trail"])
    return {"leaves": [forward(steps, symbols, trail, s)[1] for s in STATES]}


def _enter_states(chunks: pd.DataFrame) -> pd.DataFrame:
    chunks = chunks.sort_values("chunk")
    state, enters = START, []
    for leaves in chunks["leaves"]:
        enters.append(state)
        state = int(leaves[state])
    return pd.DataFrame({"_conv": chunks["_conv"], "chunk": chunks["chunk"], "enters": enters})


def _trace(steps: Steps, row: dict) -> dict:
    symbols, trail = symbols_of(row["symbols"]), _trail(row["trail"])
    state = START if row["enters"] is None else row["enters"]
    codes, state = forward(steps, symbols, trail, state)
    initials = [s % 4 for s in symbols]
    if row["follows"]:
        initials.append(symbols_of(row["follows"])[0] % 4)
        tail = 0
    else:
        # only the last chunk ends the conversation
        tail = {USER: 1, SYSTEM: 2}.get(state, 0)
    return {
        "codes": codes,
        "leaves": state,
        "tail": tail,
        "illegal": sum(pair not in LEGAL_PAIRS for pair in zip(initials, initials[1:])),
        "cost": row["constant"] + (unpack(row["found"])[START] if row["chunk"] == 0 else 0),
    }


TRACED = "_conv string, chunk bigint, codes string, leaves int, tail int, illegal bigint, cost bigint"


def traced(chunks: DataFrame, fix_ups: int = FIX_UPS) -> DataFrame:
    """Edits of each chunk: _conv, chunk, codes, leaves, tail, illegal, cost.

    A chunk is entered in the state that the one before leaves.  Chunks first work out what they leave from
    each of the four states; a conversation's chunks, four numbers each, then give the states they are entered in.
    """
    solved = settle(chunks, fix_ups)
    several = solved.where("chunk > 0").select("_conv").distinct()
    schema = "_conv string, chunk bigint, leaves array<int>"
    maps = solved.join(several, "_conv", "left_semi").mapInArrow(_each_row(schema, _map_states), schema)
    enters = maps.groupBy("_conv").applyInPandas(_enter_states, "_conv string, chunk bigint, enters int")
    follows = solved.select("_conv", (F.col("chunk") - 1).alias("chunk"), F.substring("symbols", 1, 1).alias("follows"))
    ready = solved.join(enters, ["_conv", "chunk"], "left").join(follows, ["_conv", "chunk"], "left")
    return store(ready.mapInArrow(_each_row(TRACED, _trace), TRACED), "turns-traced")


@dataclass(frozen=True)
class Repair:
    """``edits``: conv_id, place, turn, edits, turns; ``report``: one row per conversation."""

    edits: DataFrame
    report: DataFrame


def _key(conv_id: str) -> Column:
    """Text of the id that tells a null from every value."""
    return F.coalesce(F.concat(F.lit("="), F.col(conv_id).cast("string")), F.lit(""))


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def repair_conversations(turns: DataFrame, chunk_rows: int = CHUNK_ROWS, fix_ups: int = FIX_UPS) -> Repair:
    """Cheapest edits that give each conversation the role initials ``(s?(ua)+)?``.

    ``turns`` has conv_id, turn, role, text and optionally ``copies`` (times the row occurs); a null role or
    text is one space, a null conv_id a conversation of its own, other columns are not read.  Rows are ordered
    by turn (nulls first), role and the text's sha256; rows equal in all of these are adjacent and repeated.
    A row's fault is blank (no word), duplicate (role and text seen earlier) or truncated (last character
    outside blanks is not one of ``.!?``).  Keeping costs 0, a new role (user or assistant) 1, deleting 2,
    inserting an empty user or assistant turn 5, and each truncated row that stays 5; blank and duplicate rows
    are deleted.  Of equally cheap edits those with the least initials (D, I, K, R) are taken.

    ``edits`` has a row per distinct row of a conversation (and one for turns inserted at its end): its initials
    of edits, and the turns (role, text) that stand there afterwards.  ``report`` has conv_id, gaps, blank,
    duplicate, truncated, illegal, cost.  Conversations without rows have none in either.
    """
    copies = F.col("copies") if "copies" in turns.columns else F.lit(1)
    blank = ~F.col("text").rlike(WORD_PATTERN)
    rows = turns.select(
        _key("conv_id").alias("_conv"),
        "conv_id",
        "turn",
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        copies.cast("long").alias("n"),
    ).withColumn("digest", F.unhex(F.sha2("text", 256)))
    same = ["_conv", "turn", "role", "digest"]
    # whether a text ends well needs its last character outside blanks only
    ends_well = F.substring(F.rtrim(F.col("text"), F.lit(" \t\n\x0b\f\r")), -1, 1).isin(".", "!", "?")
    narrow = rows.groupBy(*same).agg(
        F.sum("n").alias("n"), F.first("conv_id").alias("conv_id"), F.first(blank).alias("blank"), F.first(ends_well).alias("ended")
    )
    narrow = store(narrow, "turns")
    order = F.struct(F.col("turn").isNotNull().alias("numbered"), F.col("turn").alias("first_turn"))
    firsts = narrow.groupBy("_conv", "role", "digest").agg(F.min(order).alias("first"))
    judged = narrow.join(firsts, ["_conv", "role", "digest"]).withColumn(
        "fresh", ~F.col("blank") & F.col("turn").eqNullSafe(F.col("first.first_turn"))
    )
    kind = F.when(~F.col("fresh"), FORCED).when(F.col("ended"), FREE).otherwise(TRUNCATED)
    initial = F.col("role").substr(1, 1)
    number = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(OTHER)
    judged = judged.select(
        *same, "conv_id", "n", "blank", "fresh", "ended", F.lit(1).cast("long").alias("one"),
        F.char(F.lit(FIRST_SYMBOL) + number + 4 * kind).alias("symbol"),
    )
    placed = running_totals(judged, ("turn", "role", "digest"), ("one",), by=("_conv",), label="turns-placed")
    placed = placed.drop("one", "one_total").withColumnRenamed("one_before", "place")
    placed = store(placed.withColumn("chunk", F.expr(f"place div {chunk_rows}")), "turns-placed")
    lists = placed.groupBy("_conv", "chunk").agg(F.sort_array(F.collect_list(F.struct("place", "symbol"))).alias("rows"))
    chunks = lists.select("_conv", "chunk", F.expr("array_join(transform(rows, r -> r.symbol), '')").alias("symbols"))
    edited = traced(chunks, fix_ups)

    at = F.ascii(F.substring("codes", (F.col("place") % chunk_rows + 1).cast("int"), 1)) - FIRST_SYMBOL + 1
    known = placed.join(edited.select("_conv", "chunk", "codes"), ["_conv", "chunk"]).select(
        *same, "conv_id", "n", "place", at.alias("code")
    )
    texts = rows.groupBy(*same).agg(F.first("text").alias("text"))
    same_row = F.lit(True)
    for c in same:
        same_row = same_row & F.col(f"t.{c}").eqNullSafe(F.col(f"k.{c}"))
    full = texts.alias("t").join(known.alias("k"), same_row).select("k.*", "t.text")
    initials = F.element_at(_strings(["I" * i + EDITS[e] for _, i, e in CODES]), F.col("code"))
    role = F.element_at(
        _strings([("", "=", new_role(s, i))[e] for s, i, e in CODES]), F.col("code")
    )
    added = F.element_at(F.array(*[_turn_list(inserted_roles(s, i)) for s, i, _ in CODES]), F.col("code"))
    stays = F.struct(F.when(role == "=", F.col("role")).otherwise(role).alias("role"), F.col("text"))
    edits = full.select(
        "conv_id",
        "place",
        "turn",
        F.concat(initials, F.repeat(F.lit("D"), (F.col("n") - 1).cast("int"))).alias("edits"),
        F.concat(added, F.when(role != "", F.array(stays)).otherwise(_turn_list([]))).alias("turns"),
    )
    ids = placed.where("place = 0").select("_conv", "conv_id")
    ended = edited.where("tail > 0").join(ids, "_conv").select(
        "conv_id",
        F.lit((1 << 62)).cast("long").alias("place"),
        F.lit(None).cast(turns.schema["turn"].dataType).alias("turn"),
        F.repeat(F.lit("I"), F.col("tail")).alias("edits"),
        F.when(F.col("tail") == 1, _turn_list(["assistant"])).otherwise(_turn_list(["user", "assistant"])).alias("turns"),
    )
    spans = placed.where("turn is not null").groupBy("_conv", "turn").agg(F.lit(1).alias("one"))
    spans = spans.groupBy("_conv").agg((F.max("turn") - F.min("turn") + 1 - F.count("one")).cast("long").alias("gaps"))
    faults = placed.groupBy("_conv").agg(
        F.first("conv_id").alias("conv_id"),
        F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).otherwise(F.col("n") - F.col("fresh").cast("int"))).alias("duplicate"),
        F.sum((F.col("fresh") & ~F.col("ended")).cast("long")).alias("truncated"),
        F.sum(F.col("n") - 1).alias("repeats"),
    )
    costs = edited.groupBy("_conv").agg(F.sum("illegal").alias("pairs"), F.sum("cost").alias("path"))
    report = faults.join(costs, "_conv").join(spans, "_conv", "left").select(
        "conv_id",
        F.coalesce("gaps", F.lit(0).cast("long")).alias("gaps"),
        "blank",
        "duplicate",
        "truncated",
        (F.col("pairs") + F.col("repeats")).alias("illegal"),
        # copies of a row are deleted beside it
        (F.col("path") + DELETE * F.col("repeats")).alias("cost"),
    )
    return Repair(edits.unionByName(ended), report)


def _turn_list(roles: list[str]) -> Column:
    if not roles:
        return F.array().cast("array<struct<role: string, text: string>>")
    return F.array(*[F.struct(F.lit(r).alias("role"), F.lit("").alias("text")) for r in roles])


def repaired_turns(edits: DataFrame) -> DataFrame:
    """The turns that stand after the edits, in order of place and part."""
    return edits.select("conv_id", "place", F.posexplode("turns").alias("part", "t")).select(
        "conv_id", "place", "part", "t.role", "t.text"
    )


DIGESTS = "_conv string, audit string, repaired_sha256 string"


def _digest_sorted(batches) -> Iterator[pa.RecordBatch]:
    """Rows in order to one row per conversation; texts are hashed as they pass."""
    form = pa.schema([("_conv", pa.string()), ("audit", pa.string()), ("repaired_sha256", pa.string())])
    conv, audit, sha, turns, done = None, [], None, 0, []

    def close():
        done.append({"_conv": conv, "audit": "".join(audit), "repaired_sha256": sha.hexdigest()})

    for batch in batches:
        for key, edits, listed in zip(*(batch.column(i) for i in range(3))):
            if key.as_py() != conv:
                if conv is not None:
                    close()
                conv, audit, sha, turns = key.as_py(), [], hashlib.sha256(), 0
            audit.append(edits.as_py())
            for t in listed.as_py():
                line = f"{t['role']}:{t['text']}"
                sha.update((f"\n{line}" if turns else line).encode("utf-8", "surrogatepass"))
                turns += 1
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=form)
            done.clear()
    if conv is not None:
        close()
        yield pa.RecordBatch.from_pylist(done, schema=form)


def digests(edits: DataFrame) -> DataFrame:
    """_conv, audit, repaired_sha256.  A digest needs its conversation in order: sorted, then streamed."""
    dealt = edits.select(_key("conv_id").alias("_conv"), "edits", "turns", "place")
    dealt = dealt.repartition(partitions(edits.sparkSession), "_conv").sortWithinPartitions("_conv", "place")
    return dealt.select("_conv", "edits", "turns").mapInArrow(_digest_sorted, DIGESTS)


def damaged(turns: DataFrame) -> DataFrame:
    """The query's damage: by a checksum rows are dropped, emptied, unpunctuated, repeated or made the user's."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hurt = turns.select(
        "conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"),
        (F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20).alias("k"),
    ).where("k <> 0")
    return hurt.select(
        "conv_id",
        "turn",
        F.when(F.col("k") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("k") == 1, "").when(F.col("k") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("k") == 3, 2).otherwise(1).alias("copies"),
    )


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    repair = repair_conversations(damaged(turns))
    every = turns.select(_key("conv_id").alias("_conv"), "conv_id").distinct()
    report = repair.report.select(_key("conv_id").alias("_conv"), "*").drop("conv_id")
    joined = every.join(report, "_conv", "left").join(digests(repair.edits), "_conv", "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return joined.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


OP11_SQL = r"""
WITH RECURSIVE bits(n, c, i) AS (
  SELECT range, range::UBIGINT, 0 FROM range(256)
  UNION ALL
  SELECT n, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, i + 1 FROM bits WHERE i < 8
), remainders AS (
  SELECT list(c ORDER BY n) AS t FROM bits WHERE i = 8
), keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
      lambda x: ascii(x)::UBIGINT) AS bytes
  FROM conversations
), checked AS (
  SELECT conv_id, turn, role, text,
    xor(list_reduce(list_prepend(4294967295::UBIGINT, bytes),
      lambda c, x: xor(c >> 8, t[(xor(c, x) & 255)::INTEGER + 1])), 4294967295::UBIGINT) % 20 AS k
  FROM keyed, remainders
), hurt AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
    CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM checked, range(2) AS copy(n) WHERE k <> 0 AND (n = 0 OR k = 3)
), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM hurt
), judged AS (
  SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen,
    regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?') AS open,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
  FROM ordered
), inserts(s, n, ends, audit, lines) AS (
  VALUES ('', 0, '', '', ''), ('', 1, 'u', 'I', chr(10) || 'user:'), ('', 2, 'a', 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
    ('s', 0, 's', '', ''), ('s', 1, 'u', 'I', chr(10) || 'user:'), ('s', 2, 'a', 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
    ('u', 0, 'u', '', ''), ('u', 1, 'a', 'I', chr(10) || 'assistant:'), ('a', 0, 'a', '', ''), ('a', 1, 'u', 'I', chr(10) || 'user:')
), paths(conv_id, i, s, best) AS (
  SELECT c.conv_id, 0::BIGINT, n.ends, {'cost': 5 * n.n, 'audit': n.audit, 'lines': n.lines}
  FROM (SELECT DISTINCT conv_id FROM judged) c, inserts n WHERE n.s = ''
  UNION ALL
  SELECT conv_id, i, s, min(best) FROM (
    SELECT e.conv_id, e.i, n.ends AS s,
      {'cost': e.cost + 5 * n.n, 'audit': e.audit || n.audit, 'lines': e.lines || n.lines} AS best
    FROM (
      SELECT p.conv_id, j.i, p.s AS s, p.best.cost + 2 AS cost, p.best.audit || 'D' AS audit, p.best.lines AS lines
      FROM paths p JOIN judged j ON p.conv_id IS NOT DISTINCT FROM j.conv_id AND p.i + 1 = j.i
      UNION ALL
      SELECT p.conv_id, j.i, left(j.role, 1), p.best.cost + CASE WHEN j.open THEN 5 ELSE 0 END, p.best.audit || 'K',
        p.best.lines || chr(10) || j.role || ':' || j.text
      FROM paths p JOIN judged j ON p.conv_id IS NOT DISTINCT FROM j.conv_id AND p.i + 1 = j.i
      WHERE NOT j.blank AND NOT j.seen AND (p.s || left(j.role, 1)) IN ('s', 'u', 'su', 'ua', 'au')
        AND left(j.role, 1) <> '' AND NOT (p.s <> '' AND left(j.role, 1) = 's')
      UNION ALL
      SELECT p.conv_id, j.i, CASE WHEN p.s = 'u' THEN 'a' ELSE 'u' END, p.best.cost + 1 + CASE WHEN j.open THEN 5 ELSE 0 END,
        p.best.audit || 'R', p.best.lines || chr(10) || CASE WHEN p.s = 'u' THEN 'assistant' ELSE 'user' END || ':' || j.text
      FROM paths p JOIN judged j ON p.conv_id IS NOT DISTINCT FROM j.conv_id AND p.i + 1 = j.i
      WHERE NOT j.blank AND NOT j.seen
    ) e JOIN inserts n ON e.s = n.s
  ) GROUP BY conv_id, i, s
), sizes AS (
  SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND seen) AS duplicate,
    count(*) FILTER (NOT blank AND NOT seen AND open) AS truncated,
    count(*) FILTER (i > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id
), ends AS (
  SELECT z.conv_id, min(p.best) AS best
  FROM sizes z JOIN paths p ON z.conv_id IS NOT DISTINCT FROM p.conv_id AND z.n = p.i
  WHERE p.s IN ('', 'a') GROUP BY z.conv_id
)
SELECT c.conv_id, coalesce(z.gaps, 0)::BIGINT AS gaps, coalesce(z.blank, 0)::BIGINT AS blank,
  coalesce(z.duplicate, 0)::BIGINT AS duplicate, coalesce(z.truncated, 0)::BIGINT AS truncated,
  coalesce(z.illegal, 0)::BIGINT AS illegal, coalesce(e.best.cost, 0)::BIGINT AS cost,
  coalesce(e.best.audit, '') AS audit, sha256(coalesce(substr(e.best.lines, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN sizes z ON c.conv_id IS NOT DISTINCT FROM z.conv_id
LEFT JOIN ends e ON c.conv_id IS NOT DISTINCT FROM e.conv_id
"""

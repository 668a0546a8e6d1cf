"""Conversation structure repair: the cheapest edits that make a conversation's roles ``(s?(ua)+)?``.

The edits are arcs of a lattice: a node is a place before a row and a state (nothing yet, after a system,
user or assistant row).  An auction finds shortest paths to an exit: the terminal node of a path bids its price up
to its best arc and the path contracts, or the path extends along a tight arc.  Converged prices are the
duals; the arcs that they leave tight are those of the cheapest repairs, and the least audit is traced along them.

Long conversations are cut into blocks of rows.  A block is known by its costs from each entry to each exit state and by
the order of their audits; blocks of blocks are the same lattice again, until a conversation is one.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from typing import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import placed, written

BLANK = " \t\n\x0b\x0c\r"
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: State after a row whose role has this initial, where the grammar allows it.
NEXT = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: State after the one role that an inserted or reroled row can have.
GIVEN = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Inserts that finish a conversation from each state.
TAIL = {EMPTY: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Rows per block, and blocks per block of the next level.
BLOCK_BITS, LEVEL_BITS = 12, 10

#: A node's arcs: label, cost, 1 for the next layer or 0 for the same one, state.
Arcs = list[tuple[object, int, int, int]]


# --- auction --------------------------------------------------------------------

def row_code(initial: str, must_go: bool, truncated: bool) -> str:
    """A row as one letter: kinds s, u, a, other; whether it must be deleted; whether it is truncated."""
    return chr(ord("A") + 4 * ("sua".find(initial or "?") + 1) + 2 * must_go + truncated)


@lru_cache(maxsize=None)
def row_arcs(code: str) -> list[Arcs]:
    """The edits of one row, by the state before it; the inserts before it are arcs inside the layer."""
    k = ord(code) - ord("A")
    initial, must_go, truncated = "?sua"[k // 4], k // 2 % 2, k % 2
    out = []
    for s in STATES:
        arcs: Arcs = [("D", DELETE, 1, s), ("I", INSERT, 0, GIVEN[s])]
        if not must_go:
            if (s, initial) in NEXT:
                arcs.append(("K", KEEP + TRUNCATED * truncated, 1, NEXT[s, initial]))
            arcs.append(("R", REROLE + TRUNCATED * truncated, 1, GIVEN[s]))
        out.append(arcs)
    return out


def connected(layers: list[list[Arcs]], exit_: int) -> list[list[bool]]:
    """Which nodes have a path to the exit; the auction is held among them."""
    out = [[False] * 4 for _ in layers] + [[s == exit_ for s in STATES]]
    for i in range(len(layers) - 1, -1, -1):
        for _ in range(3):  # two inserts lead to every state that a layer's inserts reach
            for s in STATES:
                out[i][s] = out[i][s] or any(out[i + step][t] for _, _, step, t in layers[i][s])
    return out


def auction(layers: list[list[Arcs]], exit_: int) -> tuple[list[list[int]], list[list[bool]]]:
    """Prices (distances to the exit) of all nodes that are connected to it.

    Origins come layer by layer from the exit.  Before a layer bids, its prices rise to the least of the next
    layer's: no arc costs less than nothing, so every price stays at most an arc's cost plus the price at its end.
    A path ends at the first node whose price is final; its arcs are tight, so the prices along it are final."""
    ok = connected(layers, exit_)
    price = [[0] * 4 for _ in ok]
    final = [[False] * 4 for _ in layers] + [[s == exit_ for s in STATES]]
    for i in range(len(layers) - 1, -1, -1):
        if not any(ok[i]):
            break
        least = min(price[i + 1][s] for s in STATES if ok[i + 1][s])
        price[i] = [least] * 4
        for origin in STATES:
            if not ok[i][origin] or final[i][origin]:
                continue
            path = [(i, origin)]
            while True:
                j, s = path[-1]
                bid, to = min((cost + price[j + step][t], (j + step, t)) for _, cost, step, t in layers[j][s] if ok[j + step][t])
                if price[j][s] < bid:
                    price[j][s] = bid
                    if len(path) > 1:
                        path.pop()
                elif final[to[0]][to[1]]:
                    for j, s in path:
                        final[j][s] = True
                    break
                else:
                    path.append(to)
    return price, ok


def trace(layers: list[list[Arcs]], price: list[list[int]], ok: list[list[bool]], entry: int) -> tuple[list, list[tuple[int, int]]]:
    """Labels of the least path over tight arcs, and its nodes."""
    node, labels, nodes = (0, entry), [], [(0, entry)]
    while node[0] < len(layers):
        j, s = node
        label, node = min((label, (j + step, t)) for label, cost, step, t in layers[j][s]
                          if ok[j + step][t] and price[j][s] == cost + price[j + step][t])
        labels.append(label)
        nodes.append(node)
    return labels, nodes


def summary(layers: list[list[Arcs]]) -> tuple[list[int], list[int]]:
    """Cost from each entry to each exit (4 x 4, -1: no path), and per entry the order of the exits by their least audit.

    An audit that ends with a row's edit is never the beginning of another one over the same rows, so
    audits to different exits differ inside the block, and the order holds whatever follows."""
    costs, ranks = [-1] * 16, [-1] * 16
    found: dict[int, list] = {s: [] for s in STATES}
    for t in STATES:
        price, ok = auction(layers, t)
        for s in STATES:
            if ok[0][s]:
                costs[4 * s + t] = price[0][s]
                found[s].append((trace(layers, price, ok, s)[0], t))
    for s in STATES:
        for rank, (_, t) in enumerate(sorted(found[s])):
            ranks[4 * s + t] = rank
    return costs, ranks


@lru_cache(maxsize=1 << 14)
def block_summary(codes: str) -> tuple[list[int], list[int]]:
    return summary([row_arcs(c) for c in codes])


@lru_cache(maxsize=1 << 14)
def block_audit(codes: str, entry: int, exit_: int) -> str:
    layers = [row_arcs(c) for c in codes]
    return "".join(trace(layers, *auction(layers, exit_), entry)[0])


def joined_layers(costs: list, ranks: list) -> list[list[Arcs]]:
    """Blocks in a row as a lattice: an arc per block, entry and exit, labelled by the audit's rank."""
    return [[[(int(r[4 * s + t]), int(c[4 * s + t]), 1, t) for t in STATES if c[4 * s + t] >= 0] for s in STATES] for c, r in zip(costs, ranks)]


def best_exit(costs, ranks) -> tuple[int, int]:
    """Exit and cost of a whole conversation, with the inserts that finish it."""
    cost, _, t = min((costs[t] + INSERT * len(TAIL[t]), ranks[t], t) for t in STATES if costs[t] >= 0)
    return t, int(cost)


# --- Spark ------------------------------------------------------------------------

def role_initial(role: Column) -> Column:
    return F.substring(role, 1, 1)


def with_codes(spark: SparkSession, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` (conv, turn, role, text: no null but in turn) with their place ``at`` in the order of all rows, and by place
    their first fault and code.

    They are sorted by ranges, so a long conversation spans tasks.  Rows that repeat an earlier one meet by hash of
    role and text; the least place of a group is joined back by place, which no two rows share."""
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    spread = F.monotonically_increasing_id()  # equal rows may lie in several ranges
    ordered = rows.withColumn("__spread", spread).repartitionByRange(*order, F.col("__spread")).sortWithinPartitions(*order).drop("__spread")
    ordered, _ = placed(spark, ordered, "at", "ordered-rows")
    hashes = [F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit("linedocs"), "text", "role").alias("h2")]
    first = ordered.groupBy("conv", *hashes).agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    kept = F.rtrim("text", F.lit(BLANK))
    narrow = ordered.select("conv", "at", role_initial(F.col("role")).alias("initial"), (kept == "").alias("blank"),
                            (~F.substring(kept, -1, 1).isin(".", "!", "?")).alias("cut"))
    narrow = narrow.join(first, "at", "left")
    fault = F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("cut"), "truncated")
    kind = F.instr(F.lit("sua"), F.col("initial")) * F.when(F.col("initial") != "", 1).otherwise(0)
    must = F.coalesce(F.col("fault").isin("blank", "duplicate"), F.lit(False)).cast("int")
    code = 65 + 4 * kind + 2 * must + F.coalesce(F.col("fault") == "truncated", F.lit(False)).cast("int")
    return ordered, written(spark, narrow.withColumn("fault", fault).select("conv", "at", "initial", "fault", F.char(code).alias("code")), "coded-rows")


def repaired_blocks(spark: SparkSession, coded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, from, codes, audit) of the blocks of all conversations, and (conv, cost, exit) of these.

    Upwards, blocks of conversations with several are joined, level by level, until each is one;
    downwards, the entry and exit of a block give those of its parts."""
    pair = "costs array<long>, ranks array<long>"

    def frame(found) -> pd.DataFrame:
        return pd.DataFrame({"costs": [f[0] for f in found], "ranks": [f[1] for f in found]})

    @F.pandas_udf(pair)
    def rows_summary(codes: pd.Series) -> pd.DataFrame:
        return frame([block_summary(c) for c in codes])

    @F.pandas_udf(pair)
    def parts_summary(costs: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        return frame([summary(joined_layers(c, r)) if len(c) > 1 else (c[0], r[0]) for c, r in zip(costs, ranks)])

    @F.pandas_udf("exit int, cost long")
    def chosen(costs: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([best_exit(c, r) for c, r in zip(costs, ranks)], columns=["exit", "cost"])

    @F.pandas_udf("array<struct<entry:int,exit:int>>")
    def parts_way(costs: pd.Series, ranks: pd.Series, entry: pd.Series, exit_: pd.Series) -> pd.Series:
        out = []
        for c, r, a, b in zip(costs, ranks, entry, exit_):
            layers = joined_layers(c, r)
            states = [s for _, s in trace(layers, *auction(layers, b), a)[1]]
            out.append([{"entry": x, "exit": y} for x, y in zip(states, states[1:])])
        return pd.Series(out)

    @F.pandas_udf("string")
    def rows_audit(codes: pd.Series, entry: pd.Series, exit_: pd.Series) -> pd.Series:
        return pd.Series([block_audit(c, a, b) for c, a, b in zip(codes, entry, exit_)])

    base = coded.groupBy("conv", F.shiftright("at", BLOCK_BITS).alias("g")).agg(F.sort_array(F.collect_list(F.struct("at", "code"))).alias("rows"))
    base = base.select("conv", "g", F.col("rows")[0]["at"].alias("from"), F.array_join("rows.code", "").alias("codes"))
    base = written(spark, base.withColumn("s", rows_summary("codes")).select("conv", "g", "from", "codes", "s.*"), "blocks")
    levels, roots = [], []
    level = base.select("conv", "g", "costs", "ranks")
    while True:
        several = level.groupBy("conv").agg(F.count("*").alias("n")).where("n > 1").select("conv")
        roots.append(level.join(several, "conv", "left_anti").withColumn("c", chosen("costs", "ranks")).select(
            "conv", "g", F.lit(EMPTY).alias("entry"), "c.exit", "c.cost"))
        parts = level.join(several, "conv", "left_semi").groupBy("conv", F.shiftright("g", LEVEL_BITS).alias("up")).agg(
            F.sort_array(F.collect_list(F.struct("g", "costs", "ranks"))).alias("p"))
        parts = written(spark, parts.withColumn("s", parts_summary("p.costs", "p.ranks")).select("conv", F.col("up").alias("g"), "p", "s.*"), "block-groups")
        if parts.isEmpty():
            break
        levels.append(parts)
        level = parts.select("conv", "g", "costs", "ranks")
    way = None
    for k in range(len(levels), -1, -1):
        own = roots[k].select("conv", "g", "entry", "exit")
        way = own if way is None else own.unionByName(way)
        if k:
            met = levels[k - 1].join(way, ["conv", "g"])
            steps = F.arrays_zip(F.col("p.g").alias("g"), parts_way("p.costs", "p.ranks", "entry", "exit").alias("w"))
            way = written(spark, met.select("conv", F.inline(steps)).select("conv", "g", "w.*"), "block-ways")
    blocks = base.select("conv", "g", "from", "codes").join(way, ["conv", "g"]).select(
        "conv", "from", "codes", rows_audit("codes", "entry", "exit").alias("audit"))
    ends = roots[0].select("conv", "exit", "cost")
    for r in roots[1:]:
        ends = ends.unionByName(r.select("conv", "exit", "cost"))
    return written(spark, blocks, "audits"), ends


def repaired_texts(ordered: DataFrame, blocks: DataFrame) -> DataFrame:
    """(conv, audit, repaired_sha256): the rows of a conversation meet its audits as both stream by in order.

    A digest of ordered text is sequential, so a conversation streams through one task, sorted (with spill); the task
    holds an Arrow batch and the conversation's audit, which is a cell of the result."""
    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, open_, done = None, None, []

        def put(role: str, text: str) -> None:
            open_["sha"].update(f"{open_['gap']}{role}:{text}".encode())
            open_["gap"] = "\n"

        def insert() -> None:
            open_["state"] = GIVEN[open_["state"]]
            put(ROLE[open_["state"]], "")

        def close() -> None:
            tail = TAIL[open_["state"]]
            for _ in tail:
                insert()
            done.append((conv, "".join(open_["audit"]) + tail, open_["sha"].hexdigest()))

        for frame in batches:
            for key, audit, role, text in zip(frame["conv"], frame["audit"], frame["role"], frame["text"]):
                if open_ is None or key != conv:
                    if open_:
                        close()
                    conv, open_ = key, {"sha": hashlib.sha256(), "gap": "", "state": EMPTY, "audit": [], "left": iter("")}
                if audit is not None:
                    open_["audit"].append(audit)
                    open_["left"] = iter(audit)
                    continue
                for edit in open_["left"]:
                    if edit == "I":
                        insert()
                        continue
                    if edit == "K":
                        open_["state"] = NEXT[open_["state"], role[:1]]
                        put(role, text)
                    elif edit == "R":
                        open_["state"] = GIVEN[open_["state"]]
                        put(ROLE[open_["state"]], text)
                    break
            if done:
                yield pd.DataFrame(done, columns=["conv", "audit", "repaired_sha256"])
                done = []
        if open_:
            close()
            yield pd.DataFrame(done, columns=["conv", "audit", "repaired_sha256"])

    none = F.lit(None).cast("string")
    both = blocks.select("conv", F.col("from").alias("at"), F.lit(0).alias("kind"), "audit", none.alias("role"), none.alias("text")).unionByName(
        ordered.select("conv", "at", F.lit(1).alias("kind"), none.alias("audit"), "role", "text"))
    return both.repartition("conv").sortWithinPartitions("conv", "at", "kind").select("conv", "audit", "role", "text").mapInPandas(
        digest, "conv string, audit string, repaired_sha256 string")


def repair(spark: SparkSession, rows: DataFrame, conversations: DataFrame | None = None, conv_id: str = "conv_id", turn: str = "turn",
           role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: gaps, the rows by first fault (blank, duplicate, truncated), illegal neighbours, the
    cost of the cheapest repair, its audit (K keep, R rerole, D delete, I insert) and the SHA-256 of the repaired
    ``role:text`` lines.

    Rows come in order of turn (null first), ties by role and text.  A null role or text is one space; roles count by
    their initial.  Null ids are one conversation.  ``conversations`` has the ids to report (those of ``rows`` by
    default); one without rows has zeros, an empty audit and the digest of nothing.  Other columns are not looked
    at; an empty table gives no rows."""
    kind = rows.schema[conv_id].dataType.simpleString()
    key = F.coalesce(F.concat(F.lit("="), F.col(f"`{conv_id}`").cast("string")), F.lit(""))
    named = (rows if conversations is None else conversations).select(key.alias("conv")).distinct()
    plain = rows.select(key.alias("conv"), F.col(f"`{turn}`").alias("turn"), F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"),
                        F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"))
    ordered, coded = with_codes(spark, plain)
    blocks, ends = repaired_blocks(spark, coded)
    turns = ordered.groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"))
    faults = coded.groupBy("conv").agg(*[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")])
    legal = F.concat("initial", "next").isin("su", "ua", "au")
    after = coded.select("conv", (F.col("at") - 1).alias("at"), F.col("initial").alias("next"))
    illegal = coded.join(after, ["conv", "at"]).groupBy("conv").agg(F.count_if(~legal).alias("illegal"))
    out = named
    for part in (turns, faults, illegal, ends.select("conv", "cost"), repaired_texts(ordered, blocks)):
        out = out.join(part, "conv", "left")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return out.select(F.when(F.col("conv") != "", F.substring("conv", 2, 1 << 30)).cast(kind).alias("conv_id"),
                      *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in numbers],
                      F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def damaged(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``rows`` damaged by crc32(conv_id:turn) mod 20, a null being one space: 0 drops a row, 1 empties its text, 2 takes its
    sentence ends, 3 repeats it, 4 makes it the user's."""
    def given(c: str) -> Column:
        return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))

    at = F.pmod(F.crc32(F.concat(given(conv_id), F.lit(":"), given(turn)).cast("binary")), F.lit(20))
    out = rows.withColumn("__damage", at).where("__damage <> 0")
    out = out.withColumns({text: F.when(F.col("__damage") == 1, "").when(F.col("__damage") == 2, F.regexp_replace(given(text), "[.!?]", "")).otherwise(given(text)),
                           role: F.when(F.col("__damage") == 4, "user").otherwise(given(role))})
    times = F.when(F.col("__damage") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return out.withColumn("__copy", F.explode(times)).drop("__damage", "__copy")

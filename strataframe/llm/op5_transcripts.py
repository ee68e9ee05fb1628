"""Transcript parsing by a hidden Markov model, and canonical chat turns.

A transcript is a sequence of lines; some open with a speaker marker, some do not, and a turn may have
many lines. The hidden state of a line is its role and whether it begins a turn. A line is observed as
its marker and a few features. Every rate (how often a turn is marked, goes on, follows another, how a
role's lines look) is estimated from all lines by expectation-maximisation: tasks give expected counts of
their blocks, fixed in number, and Spark sums them.

Roles are recovered by Viterbi. A conversation is cut into blocks of lines, packed as one number per
line; each block becomes the matrix of best scores from the state before it to its last state. Blocks of
blocks are reduced the same way until one matrix is left, and the best states at its ends are handed down
again, so a conversation of any length is decoded exactly and no task holds more than one block of it.
Blocks of a batch are stepped together. Text only meets the states of its block, once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataframe.llm.tables import cut_lineage, partitions, table

ROLES = ("system", "user", "assistant")
BLOCK_LINES = 512
STATES = 2 * len(ROLES)  # role r begins a turn: 2 r; goes on with it: 2 r + 1
# Markers by role.
MARKERS = {
    "system": ("system", "instructions", "context"),
    "user": ("user", "human", "q", "question", "customer", "me"),
    "assistant": ("assistant", "ai", "a", "answer", "bot", "agent"),
}
MARKER = r"^\s*[\[*#<(]{0,3}([A-Za-z]{1,12})[\])>*]{0,3}\s*(?::|>>|\|)[*]{0,2}\s*"
QUOTE = r"^\s*>\s+"  # a quoted line is the user's
N_MARKS = 5  # none, one per role, unknown name
BUNDLE_ROWS = 1 << 17  # lines, or matrices of blocks, that one call holds at most on average
N_LOOKS = 12
N_OBSERVED = N_MARKS * N_LOOKS
N_COUNTS = STATES + STATES**2 + STATES * N_OBSERVED
OBSERVED_BITS = 6  # of a packed line; the bits above are its place in the block
STEPPED = 1024  # blocks that are stepped together
# Starting beliefs, as counts that the corpus' own counts are added to.
FOLLOWS = np.array([[1.0, 18.0, 1.0], [0.2, 1.0, 20.0], [0.2, 20.0, 1.0]])
OPENS = np.array([4.0, 14.0, 2.0])
STAYS = 0.5
# How often the first line of a turn has its role's marker, each other's, an unknown name, none; and a later line.
MARKED = np.array([[0.70, 0.01, 0.04, 0.24], [0.01, 0.01, 0.02, 0.95]])
BELIEF = 20.0  # lines that STAYS and each row of MARKED count for
MAX_PASSES, SETTLED = 12, 0.002


def marker_role(line: Column) -> Column:
    """0 without a marker, 1 to 3 for a role's, 4 for an unknown name."""
    name = F.lower(F.regexp_extract(line, MARKER, 1))
    mark = F.when(line.rlike(QUOTE), 2)
    for k, role in enumerate(ROLES):
        mark = mark.when(name.isin(*MARKERS[role]), k + 1)
    return mark.when(name != "", 4).otherwise(0)


def unmarked(line: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(line, QUOTE, ""), MARKER, "")


def content(line: Column) -> Column:
    """The line without its marker, if that names a role."""
    return F.when(marker_role(line).between(1, 3), unmarked(line)).otherwise(line)


def look(line: Column) -> Column:
    """Length class (4) and ending (3) of a line, as one number."""
    size = F.length(line)
    length = F.when(size < 20, 0).when(size < 80, 1).when(size < 240, 2).otherwise(3)
    ending = F.when(line.rlike(r"\?\s*$"), 0).when(line.rlike(r"[.!]\s*$"), 1).otherwise(2)
    return length * 3 + ending


def pack(lines: DataFrame) -> DataFrame:
    """Blocks ``(conv_id, at, seen, before)`` of lines (conv_id, line_no, observed): one number per line, and the last
    observation of the block before (NULL without one)."""
    at = F.floor(F.col("line_no") / BLOCK_LINES)
    line = F.shiftleft((F.col("line_no") - at * BLOCK_LINES).cast("int"), OBSERVED_BITS) + F.col("observed")
    blocks = cut_lineage(lines.groupBy("conv_id", at.alias("at")).agg(F.array_sort(F.collect_list(line)).alias("seen")))
    lasts = blocks.select("conv_id", (F.col("at") + 1).alias("at"), (F.element_at("seen", -1) % (1 << OBSERVED_BITS)).alias("before"))
    return cut_lineage(blocks.join(lasts, ["conv_id", "at"], "left"))


class Blocks:
    """Some packed blocks, the longest first, so that those that reach a step come first."""

    def __init__(self, batch: pa.RecordBatch):
        lines = batch.column("seen")
        size = lines.value_lengths().to_numpy()
        order = np.argsort(-size, kind="stable")
        self.batch, self.size = batch.take(pa.array(order)), size[order]
        values = self.batch.column("seen").flatten().to_numpy()
        self.real = np.arange(self.size[0])[None] < self.size[:, None]
        grid = np.zeros(self.real.shape, np.int32)
        grid[self.real] = values
        self.seen, self.place = grid & ((1 << OBSERVED_BITS) - 1), grid >> OBSERVED_BITS
        self.opens = (self.batch.column("at").to_numpy() == 0) & (self.place[:, 0] == 0)
        # How many blocks have a line at each step.
        self.reach = self.real.sum(0)

    def steps(self, model, t: int) -> np.ndarray:
        """Scores from the state before line ``t`` of each block to the state of that line."""
        first, step, emit = model
        seen = emit.T[self.seen[: self.reach[t], t]][:, None, :]
        found = step[None] + seen
        return np.where(self.opens[:, None, None], first[None, None] + seen, found) if t == 0 else found


def stepped(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, STEPPED):
            yield Blocks(batch.slice(at, STEPPED))


def best_scores(blocks: Blocks, model) -> np.ndarray:
    """Of each block the best scores from the state before it to its last state."""
    total = blocks.steps(model, 0)
    for t in range(1, len(blocks.reach)):
        k = blocks.reach[t]
        total[:k] = (total[:k, :, :, None] + blocks.steps(model, t)[:, None]).max(2)
    return total


def best_states(blocks: Blocks, model, entry: np.ndarray, leave: np.ndarray) -> np.ndarray:
    """States of each block's lines on the best path from ``entry`` to ``leave``; of equal ones the lower."""
    score, back = blocks.steps(model, 0)[np.arange(len(entry)), entry], []
    for t in range(1, len(blocks.reach)):
        through = score[: blocks.reach[t], :, None] + blocks.steps(model, t)
        back.append(through.argmax(1).astype(np.int8))
        score[: blocks.reach[t]] = through.max(1)
    states, now = np.zeros(blocks.seen.shape, np.int8), leave.astype(np.int8)
    for t in range(len(blocks.reach) - 1, 0, -1):
        k = blocks.reach[t]
        states[:k, t] = now[:k]
        now[:k] = back[t - 1][np.arange(k), now[:k]]
    states[:, 0] = now
    return states


def expected_counts(blocks: Blocks, model) -> np.ndarray:
    """Expected openings, steps from state to state and observations by state, in one row.

    The state before a block is weighed by the last observation before it; what follows a block is left out.
    """
    first, step, emit = (np.exp(part) for part in model)
    reach, n = blocks.reach, len(blocks.size)
    before = blocks.batch.column("before").fill_null(-1).to_numpy()
    entry = np.where((before >= 0)[:, None], emit.T[before], 1.0)
    entry /= entry.sum(1, keepdims=True)
    said = emit.T[blocks.seen]
    ahead, scale = np.zeros((len(reach), n, STATES)), np.ones((len(reach), n, 1))
    for t, k in enumerate(reach):
        came = np.where(blocks.opens[:, None], first, entry @ step) if t == 0 else ahead[t - 1, :k] @ step
        score = came * said[:k, t]
        scale[t, :k] = score.sum(1, keepdims=True)
        ahead[t, :k] = score / scale[t, :k]
    behind, steps = np.ones((n, STATES)), np.zeros((STATES, STATES))
    weight = np.zeros((n, len(reach), STATES))
    for t in range(len(reach) - 1, -1, -1):
        k = reach[t]
        weight[:k, t] = ahead[t, :k] * behind[:k]
        seen = said[:k, t] * behind[:k] / scale[t, :k]
        came = entry * ~blocks.opens[:, None] if t == 0 else ahead[t - 1, :k]
        steps += step * (came.T @ seen)
        behind[:k] = seen @ step.T
    opened = weight[blocks.opens, 0].sum(0)
    keys = (np.arange(STATES) * N_OBSERVED)[None] + blocks.seen[blocks.real][:, None]
    emitted = np.bincount(keys.ravel(), weight[blocks.real].ravel(), STATES * N_OBSERVED)
    return np.concatenate([opened, steps.ravel(), emitted])


def model_of(counts: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], np.ndarray]:
    """Log scores (first state, state to state, state to observation) of expected counts, and the rates that must settle."""
    opened, steps, emitted = np.split(counts, [STATES, STATES + STATES**2])
    steps, emitted = steps.reshape(len(ROLES), 2, len(ROLES), 2).sum(1), emitted.reshape(len(ROLES), 2, N_MARKS, N_LOOKS)
    opens = OPENS + opened[::2]
    follows = FOLLOWS + steps[:, :, 0]
    stays, begins = steps[:, :, 1].sum() + BELIEF * STAYS, steps[:, :, 0].sum() + BELIEF * (1 - STAYS)
    looks = emitted.sum((1, 2)) + 1
    marks = emitted.sum(3)
    own = np.array([marks[r, :, r + 1] for r in range(len(ROLES))]).sum(0)
    known = marks[:, :, 1:4].sum((0, 2))
    rates = np.stack([own, (known - own) / 2, marks[:, :, 4].sum(0), marks[:, :, 0].sum(0)], 1) + BELIEF * MARKED
    rates /= (rates * [1, 2, 1, 1]).sum(1, keepdims=True)
    # Sums of floats depend on their order in the last digits, the model must not.
    rates, stay = rates.round(6), round(stays / (stays + begins), 6)
    opens, follows, looks = ((part / part.sum(-1, keepdims=True)).round(6) for part in (opens, follows, looks))
    step, first = np.zeros((STATES, STATES)), np.zeros(STATES)
    emit = np.zeros((STATES, N_OBSERVED))
    for r in range(len(ROLES)):
        first[2 * r] = opens[r]
        for begun in (2 * r, 2 * r + 1):
            step[begun, 2 * r + 1] = stay
            step[begun, ::2] = (1 - stay) * follows[r]
        for later in (0, 1):
            own, other, name, none = rates[later]
            by_mark = np.array([none, *(own if k == r else other for k in range(3)), name])
            emit[2 * r + later] = np.outer(by_mark, looks[r]).ravel()
    logs = tuple(np.log(np.maximum(part, 1e-12)) for part in (first, step, emit))
    return logs, np.append(rates.ravel(), stay)


def learn(blocks: DataFrame):
    """The model of packed blocks, by expectation-maximisation. Counts, fixed in number, are collected; no lines."""
    model, rates = model_of(np.zeros(N_COUNTS))
    for _ in range(MAX_PASSES):
        def count(batches, model=model):
            total = np.zeros(N_COUNTS)
            for found in stepped(batches):
                total += expected_counts(found, model)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["key", "n"])

        summed = blocks.mapInArrow(count, "key bigint, n double").groupBy("key").agg(F.sum("n").alias("n")).orderBy("key").collect()
        if not summed:
            break
        model, now = model_of(np.array([r.n for r in summed]))
        settled, rates = np.abs(now - rates).max() < SETTLED, now
        if settled:
            break
    return model


def fit(lines: DataFrame):
    """Log scores: first state, state to state, state to observation, of lines (conv_id, line_no, observed)."""
    return learn(pack(lines))


def reduce_path(matrices: np.ndarray) -> np.ndarray:
    """Best scores from the state before a run of steps to the state after it."""
    total = matrices[0]
    for m in matrices[1:]:
        total = (total[:, :, None] + m[None]).max(1)
    return total


def best_path(matrices: np.ndarray, entry: int, leave: int) -> np.ndarray:
    """States after each step of the best path from ``entry`` to ``leave``; of equal ones the lower."""
    score, back = matrices[0][entry], []
    for m in matrices[1:]:
        through = score[:, None] + m
        back.append(through.argmax(0))
        score = through.max(0)
    path = [leave]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return np.array(path[::-1], np.int64)


def _groups(part: pa.Table, *keys: str):
    frame = part.to_pandas().sort_values([*keys, "at"], kind="stable")
    for _, rows in frame.groupby(list(keys), sort=True):
        yield rows


def _list_column(values: np.ndarray, size: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), pa.array(values))


def decode_blocks(blocks: DataFrame, model) -> tuple[DataFrame, bool]:
    """``(conv_id, at, places, states, begins)`` of packed blocks, and whether each conversation is one block.

    By line of the block: its place, its state, and the place of the last line that opens a turn (-1 if that is in a block before).
    """
    n = partitions(blocks.sparkSession)

    def lowest(batches):
        for found in stepped(batches):
            scores = np.ascontiguousarray(best_scores(found, model), "<f8").reshape(len(found.size), -1)
            yield pa.RecordBatch.from_arrays(
                [found.batch.column("conv_id"), found.batch.column("at"), pa.array([m.tobytes() for m in scores], pa.binary())],
                names=["conv_id", "at", "matrix"])

    def stored(rows):
        return np.stack([np.frombuffer(m, "<f8").reshape(STATES, STATES) for m in rows["matrix"]])

    def up(part: pa.Table) -> pa.Table:
        out = [(rows["conv_id"].iloc[0], rows["group"].iloc[0], reduce_path(stored(rows)).astype("<f8").tobytes())
               for rows in _groups(part, "conv_id", "group")]
        conv, at, matrix = zip(*out)
        return pa.table({"conv_id": pa.array(conv, pa.int64()), "at": pa.array(at, pa.int64()), "matrix": pa.array(matrix, pa.binary())})

    def down(part: pa.Table) -> pa.Table:
        conv, at, entries, states = [], [], [], []
        for rows in _groups(part, "conv_id", "group"):
            entry = int(rows["entry"].iloc[0])
            path = best_path(stored(rows), entry, int(rows["leave"].iloc[0]))
            conv.append(rows["conv_id"].to_numpy())
            at.append(rows["at"].to_numpy())
            entries.append(np.concatenate([[entry], path[:-1]]))
            states.append(path)
        return pa.table({"conv_id": np.concatenate(conv), "at": np.concatenate(at).astype(np.int64),
                         "entry": np.concatenate(entries).astype(np.int32), "leave": np.concatenate(states).astype(np.int32)})

    def ends(batches):
        for batch in batches:
            leave = [int(np.frombuffer(m.as_py(), "<f8").reshape(STATES, STATES)[0].argmax()) for m in batch.column("matrix")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("at"), pa.array([0] * len(leave), pa.int32()), pa.array(leave, pa.int32())],
                names=["conv_id", "at", "entry", "leave"])

    def solve(batches):
        for found in stepped(batches):
            ends_of = (found.batch.column(name).to_numpy() for name in ("entry", "leave"))
            states = best_states(found, model, *ends_of)
            begins = np.maximum.accumulate(np.where(states % 2 == 0, found.place, -1), axis=1)
            yield pa.RecordBatch.from_arrays(
                [found.batch.column("conv_id"), found.batch.column("at"),
                 *(_list_column(of[found.real], found.size) for of in (found.place, states, begins.astype(np.int32)))],
                names=["conv_id", "at", "places", "states", "begins"])

    def bundled(df, rows):
        # As many bundles as the rows need, so that what one task holds does not grow with the table.
        return df.groupBy(F.pmod(F.xxhash64("conv_id", "group"), F.lit(max(8 * n, -(-rows // BUNDLE_ROWS)))))

    # Upwards: blocks, blocks of blocks, ..., one matrix per conversation.
    upper = cut_lineage(blocks.mapInArrow(lowest, "conv_id bigint, at bigint, matrix binary"))
    levels = []
    while True:
        top, rows = upper.agg(F.max("at"), F.count("*")).first()
        levels.append((upper, rows))
        if top in (0, None):
            break
        tagged = upper.withColumn("group", F.floor(F.col("at") / BLOCK_LINES))
        upper = cut_lineage(bundled(tagged, rows).applyInArrow(up, "conv_id bigint, at bigint, matrix binary"))
    solved = upper.mapInArrow(ends, "conv_id bigint, at bigint, entry int, leave int")
    for table_, rows in levels[-2::-1]:
        above = solved.withColumnRenamed("at", "group")
        below = table_.withColumn("group", F.floor(F.col("at") / BLOCK_LINES)).join(above, ["conv_id", "group"])
        solved = bundled(below, rows).applyInArrow(down, "conv_id bigint, at bigint, entry int, leave int")
    found = blocks.join(solved, ["conv_id", "at"]).mapInArrow(
        solve, "conv_id bigint, at bigint, places array<int>, states array<tinyint>, begins array<int>")
    return found, len(levels) == 1


def decode(lines: DataFrame, model) -> DataFrame:
    """``(conv_id, line_no, state)`` of all lines (conv_id, line_no, observed)."""
    found, _ = decode_blocks(pack(lines), model)
    line = F.explode(F.arrays_zip("places", "states")).alias("line")
    return found.select("conv_id", "at", line).select(
        "conv_id", (F.col("at") * BLOCK_LINES + F.col("line.places")).alias("line_no"), F.col("line.states").cast("int").alias("state"))


def parse(transcripts: DataFrame) -> DataFrame:
    """Turns ``(conv_id, turn, role, text, rendered)`` of transcript lines ``(conv_id, line_no, line)``.

    ``line_no`` counts a conversation's lines from 0 without gaps. ``turn`` is the number of the turn's
    first line. A NULL line is an empty one; lines with NULL conv_id are left out, as are repeats of a
    line number but the smallest line. Other columns are ignored; no lines give no turns.
    """
    lines = (
        transcripts.where("conv_id is not null and line_no is not null")
        .groupBy(F.col("conv_id").cast("long").alias("conv_id"), F.col("line_no").cast("long").alias("line_no"))
        .agg(F.min(F.coalesce("line", F.lit(""))).alias("line"))
        .withColumn("at", F.floor(F.col("line_no") / BLOCK_LINES)).withColumn("mark", marker_role(F.col("line")))
        .withColumn("said", F.when(F.col("mark").between(1, 3), unmarked(F.col("line"))).otherwise(F.col("line")))
        .withColumn("observed", (F.col("mark") * N_LOOKS + look(F.col("said"))).cast("int"))
        .withColumn("marker", F.length("line") - F.length("said")).drop("mark", "said")
    )
    lines = cut_lineage(lines)
    blocks = pack(lines.select("conv_id", "line_no", "observed"))
    found, one_block_each = decode_blocks(blocks, learn(blocks))
    found = cut_lineage(found)
    # A block's first lines may belong to a turn that begins in a block before, its last turn may go on in the next.
    order = Window.partitionBy("conv_id").orderBy("at")
    last = F.element_at("begins", -1)
    edges = found.select("conv_id", "at", F.when(last >= 0, F.col("at") * BLOCK_LINES + last).alias("last")).select(
        "conv_id", "at", "last", F.coalesce(F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("carried"),
        F.lead("at").over(order).isNull().alias("ending"))
    known = lines.join(found.join(edges, ["conv_id", "at"]), ["conv_id", "at"])
    known = known.withColumn("i", F.array_position("places", (F.col("line_no") - F.col("at") * BLOCK_LINES).cast("int")).cast("int") - 1)
    known = known.withColumns({"state": F.get("states", F.col("i")), "begin": F.get("begins", F.col("i"))})
    role = F.element_at(F.array(*map(F.lit, ROLES)), (F.floor(F.col("state") / 2) + 1).cast("int"))
    said = F.when(F.col("state") % 2 == 0, F.expr("substring(line, marker + 1)")).otherwise(F.col("line"))
    turn = F.when(F.col("begin") >= 0, F.col("at") * BLOCK_LINES + F.col("begin")).otherwise(F.col("carried"))
    whole = (F.col("begin") >= 0) & (F.col("ending") | (turn < F.col("last")))
    # The join has brought a block's lines together, so its pieces of turns need no shuffle.
    pieces = known.select("conv_id", "at", turn.alias("turn"), "line_no", role.alias("role"), said.alias("said"), whole.alias("whole")).groupBy(
        "conv_id", "at", "turn").agg(
        F.min_by("role", "line_no").alias("role"), F.max("whole").alias("whole"),
        F.array_sort(F.collect_list(F.struct("line_no", "said"))).alias("parts"))
    pieces = pieces.select("conv_id", "at", "turn", "role", "whole", F.array_join(F.transform("parts", lambda p: p["said"]), "\n").alias("text"))
    turns = pieces.select("conv_id", "turn", "role", "text")
    if not one_block_each:
        split = pieces.where("not whole").groupBy("conv_id", "turn").agg(
            F.min_by("role", "at").alias("role"), F.array_sort(F.collect_list(F.struct("at", "text"))).alias("parts"))
        split = split.select("conv_id", "turn", "role", F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("text"))
        turns = pieces.where("whole").select("conv_id", "turn", "role", "text").unionAll(split)
    return turns.withColumn(
        "rendered", F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), F.col("text"), F.lit("\n<|end|>")))


def raw_transcripts(conversations: DataFrame) -> DataFrame:
    """The lines of conversations as found in the wild: four marker styles, about one turn in six unmarked.

    A conversation with two rows for one turn keeps the smaller (role, text). Line numbers come from
    sums over blocks of turns, so a long conversation is numbered in pieces.
    """
    key = F.crc32(F.concat_ws(":", F.col("conv_id"), F.col("turn")).cast("binary"))
    style = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    names = [("System: ", "User: ", "Assistant: "), ("[system]: ", "Human: ", "AI: "), ("Context: ", "Q: ", "A: "), ("**System**: ", "> ", "")]
    mark = F.lit("")
    for k, chosen in enumerate(names):
        for role, name in zip(ROLES, chosen):
            mark = F.when((style == k) & (F.col("role") == role), name).otherwise(mark)
    mark = F.when(key % 6 == 0, "").otherwise(mark)
    turns = conversations.where("conv_id is not null and turn is not null").groupBy("conv_id", "turn").agg(
        F.min(F.struct("role", F.coalesce("text", F.lit("")).alias("text"))).alias("m"))
    turns = turns.select("conv_id", "turn", F.col("m.role").alias("role"), F.split(F.col("m.text"), "\n").alias("lines"))
    turns = turns.withColumn("block", F.floor(F.col("turn") / BLOCK_LINES))
    sizes = turns.groupBy("conv_id", "block").agg(F.sum(F.size("lines")).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("conv_id", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inner = Window.partitionBy("conv_id", "block").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    placed = turns.join(sizes, ["conv_id", "block"]).withColumn("begin", F.col("base") + F.coalesce(F.sum(F.size("lines")).over(inner), F.lit(0)))
    return placed.withColumn("mark", mark).select("conv_id", "turn", "role", "begin", "mark", F.posexplode("lines").alias("i", "body")).select(
        "conv_id", (F.col("begin") + F.col("i")).alias("line_no"),
        F.when(F.col("i") == 0, F.concat("mark", "body")).otherwise(F.col("body")).alias("line"),
        F.when(F.col("i") == 0, F.col("role")).alias("role"), "turn",
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse(raw_transcripts(table(spark, sf_dir, "conversations")).select("conv_id", "line_no", "line"))

"""Roles and canonical turns from raw transcripts, by a hidden Markov model over lines.

A state is a role and whether the line opens a turn or goes on with one. A line is seen as a symbol: which
speaker marker it begins with, whether the line before was blank, and how long it is. The model's figures are
counted from transcripts with known roles. Viterbi's best states are found in blocks: transcripts are sorted
over all tasks in ranges, so one of any length lies in several blocks; each block is first condensed to the
best score from any state before it to any state at its end, these are chained, and every block then knows the
state it begins after and the one it ends in.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lines import _order
from .tables import saved

ROLES = ("system", "user", "assistant")
#: states: a role's opening line, then its further lines
STATES = 2 * len(ROLES)
#: names of speakers and the role they stand for
SPEAKERS = {"system": 0, "instruction": 0, "instructions": 0, "context": 0, "user": 1, "human": 1, "q": 1,
            "question": 1, "customer": 1, "me": 1, "prompt": 1, "assistant": 2, "ai": 2, "bot": 2, "a": 2,
            "answer": 2, "agent": 2, "model": 2, "response": 2, "gpt": 2}
_NAMES = "|".join(sorted(SPEAKERS, key=len, reverse=True))
#: a speaker marker: the name between or before signs, as in "User:", "### Assistant", "[AI]", "<|im_start|>user"
MARKER = (rf"(?i)^\s*(?:<\|im_start\|>({_NAMES})\s*$|<\|({_NAMES})\|>|\[({_NAMES})\]:?|#{{1,4}} *({_NAMES}) *:?\s*$"
          rf"|\*\*({_NAMES})(?::\*\*|\*\*:)|({_NAMES}) *:(?!//))")
END = r"(?i)^\s*(?:<\|im_end\|>|<\|end\|>|</s>)\s*$"
LENGTHS = (20, 80, 300)
SYMBOLS = 5 * 2 * (len(LENGTHS) + 2)


def line_symbols(rows: DataFrame, line: str = "line", before: str = "before") -> DataFrame:
    """Adds ``symbol`` and ``marker`` (the text that marks the speaker, else empty) to rows with a line and the
    one before it (null at the start)."""
    name = F.lower(F.concat(*[F.regexp_extract(line, MARKER, i) for i in range(1, 7)]))
    speaker = F.lit(3)
    for role in range(len(ROLES)):
        speaker = F.when(name.isin(*[s for s, r in SPEAKERS.items() if r == role]), role).otherwise(speaker)
    speaker = F.when(F.col(line).rlike(END), 4).otherwise(speaker)
    size = F.length(F.trim(line))
    long = F.when(size == 0, 0).otherwise(1 + sum((size > n).cast("int") for n in LENGTHS))
    gap = F.coalesce(F.trim(before) == "", F.lit(True)).cast("int")
    return rows.withColumn("marker", F.regexp_extract(line, MARKER, 0)).withColumn(
        "symbol", ((speaker * 2 + gap) * (len(LENGTHS) + 2) + long).cast("int"))


@dataclass
class Model:
    """Log weights: of the first state, of moves, and of symbols in a state."""

    first: np.ndarray
    moves: np.ndarray
    symbols: np.ndarray


def count_model(lines: DataFrame, extra: float = 0.5) -> Model:
    """The model from rows (state, symbol, after: the state before, null at the start) with known states. Only
    counts, at most states x states and states x symbols, reach the driver."""
    moves = np.full((STATES, STATES), extra)
    first = np.full(STATES, extra)
    seen = np.full((STATES, SYMBOLS), extra / 10)
    for r in lines.groupBy("after", "state").count().collect():
        if r.after is None:
            first[r.state] += r["count"]
        else:
            moves[r.after, r.state] += r["count"]
    for r in lines.groupBy("state", "symbol").count().collect():
        seen[r.state, r.symbol] += r["count"]
    for role in range(len(ROLES)):
        first[2 * role + 1] = 1e-9  # nothing goes on that did not begin
        for other in range(STATES):
            if other // 2 != role:
                moves[other, 2 * role + 1] = 1e-9
    return Model(*(np.log(x / x.sum(axis=-1, keepdims=True)) for x in (first, moves, seen)))


def _groups(batches, columns):
    """Rows of whole groups (chat, block), about 200,000 at a time, from rows sorted by them."""
    held: list[pa.RecordBatch] = []
    size = 0

    def table(parts):
        return {c: np.concatenate([p.column(c).to_numpy(zero_copy_only=False) for p in parts]) for c in columns}

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        if size >= 200_000:
            rows = table(held)
            key = np.stack([rows["chat"], rows["block"]])
            change = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0))
            if len(change):
                cut = change[-1] + 1
                yield {c: v[:cut] for c, v in rows.items()}
                rest = pa.Table.from_batches(held).slice(cut).combine_chunks().to_batches()
                held, size = rest, sum(b.num_rows for b in rest)
    if held:
        yield table(held)


def _of(rows) -> np.ndarray:
    new = np.ones(len(rows["chat"]), bool)
    new[1:] = (np.diff(rows["chat"]) != 0) | (np.diff(rows["block"]) != 0)
    return np.cumsum(new) - 1


def _condensed(model: Model):
    """Of each block the best score from each state before it to each state at its end (or, for the first block
    of a chat, from the start), and how many turns open on each of these paths."""

    def work(batches):
        for rows in _groups(batches, ("chat", "block", "symbol")):
            of = _of(rows)
            turns = _order(of)
            emit = model.symbols[:, rows["symbol"]].T
            score = np.zeros((len(of), STATES, STATES))
            for t, now in enumerate(turns):
                if t == 0:
                    begin = rows["block"][now] == 0
                    move = np.where(begin[:, None, None], model.first[None, None, :], model.moves[None])
                    score[now] = move + emit[now][:, None, :]
                else:
                    score[now] = (score[now - 1][:, :, :, None] + model.moves[None, None]).max(axis=2) + emit[now][:, None, :]
            last = np.flatnonzero(np.append(np.diff(of) > 0, True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows["chat"][last]), pa.array(rows["block"][last]),
                 pa.array(list(score[last].reshape(len(last), -1)), pa.list_(pa.float64()))], ["chat", "block", "score"])

    return work


def _chained(batches):
    """The state before and the state at the end of each block of a chat, from the blocks of the chat in order.
    One row per block is held."""
    held: list[tuple] = []

    def solved():
        score = np.zeros(STATES)
        back = []
        for _, _, matrix in held:
            whole = score[:, None] + matrix
            back.append(whole.argmax(axis=0))
            score = whole.max(axis=0)
        state, out = int(score.argmax()), []
        for (chat, block, _), b in zip(reversed(held), reversed(back)):
            out.append((chat, block, int(b[state]), state))
            state = int(b[state])
        return out

    for batch in batches:
        out = []
        for chat, block, score in zip(*(c.to_pylist() for c in batch.columns)):
            if held and held[-1][0] != chat:
                out += solved()
                held = []
            held.append((chat, block, np.array(score).reshape(STATES, STATES)))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], ["chat", "block", "enter", "leave"])
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*solved())], ["chat", "block", "enter", "leave"])


def _decoded(model: Model):
    """The state of each line, from the states that its block begins after and ends in."""

    def work(batches):
        for rows in _groups(batches, ("chat", "block", "pos", "symbol", "enter", "leave")):
            of = _of(rows)
            turns = _order(of)
            emit = model.symbols[:, rows["symbol"]].T
            score = np.zeros((len(of), STATES))
            back = np.zeros((len(of), STATES), np.int8)
            for t, now in enumerate(turns):
                if t == 0:
                    begin = rows["block"][now] == 0
                    score[now] = np.where(begin[:, None], model.first[None], model.moves[rows["enter"][now]]) + emit[now]
                else:
                    whole = score[now - 1][:, :, None] + model.moves[None]
                    back[now] = whole.argmax(axis=1)
                    score[now] = whole.max(axis=1) + emit[now]
            state = rows["leave"].astype(np.int64).copy()
            for now in reversed(turns[1:]):
                state[now - 1] = back[now, state[now]]
            yield pa.RecordBatch.from_arrays([pa.array(rows["chat"]), pa.array(rows["block"]), pa.array(rows["pos"]),
                                              pa.array(state)], ["chat", "block", "pos", "state"])

    return work


def transcript_lines(rows: DataFrame, chat: str, order: list[Column], text: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Lines of transcripts given as rows of text: (chat, block, pos, line, before) and the columns ``keep``.
    Rows are sorted by range over all tasks; the part of a chat in one range is a block, numbered from 0. A null
    text has no lines; rows without a chat are left out."""
    spark = rows.sparkSession
    parts = rows.select(F.col(chat).cast("long").alias("chat"), F.struct(*order).alias("o"),
                        F.col(text).cast("string").alias("text"), *keep).where("chat is not null and text is not null")
    count = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    # equal orders are told apart by the text, so that very many of them still spread over ranges
    sort = ["chat", "o", F.xxhash64("text")]
    ranged = (parts.repartitionByRange(count, *sort).sortWithinPartitions(*sort)
              .select("chat", F.monotonically_increasing_id().alias("row"), F.split("text", "\r\n|\n|\r").alias("lines"), *keep))
    ranged = saved(ranged, "ranges")  # cut here, as a second sort could draw other ranges
    ranged = ranged.select("chat", F.shiftright("row", 33).alias("range"), F.col("row").bitwiseAND((1 << 33) - 1).alias("row"), "lines", *keep)
    ahead = F.lag(F.element_at("lines", -1)).over(Window.partitionBy("chat", "range").orderBy("row"))
    pairs = F.arrays_zip(F.col("lines"), F.concat(F.array(F.col("ahead")), F.slice("lines", 1, F.size("lines") - 1)))
    each = ranged.withColumn("ahead", ahead).select("chat", "range", "row", *keep, F.posexplode(pairs).alias("i", "z"))
    first = ranged.groupBy("chat").agg(F.min("range").alias("zero"))
    return each.join(first, "chat").select(
        "chat", (F.col("range") - F.col("zero")).alias("block"),
        (F.shiftleft("row", 30) + F.col("i")).alias("pos"), F.col("z")["lines"].alias("line"),
        F.col("z")["1"].alias("before"), "i", *keep)


def best_states(lines: DataFrame, model: Model) -> DataFrame:
    """(chat, block, pos, state) of every line of ``lines(chat, block, pos, symbol)``."""
    lines = lines.select("chat", "block", "pos", "symbol")
    spread = lines.repartition("chat", "block").sortWithinPartitions("chat", "block", "pos")
    ends = (spread.mapInArrow(_condensed(model), "chat long, block long, score array<double>")
            .repartition("chat").sortWithinPartitions("chat", "block")
            .mapInArrow(_chained, "chat long, block long, enter long, leave long"))
    known = lines.join(ends, ["chat", "block"]).repartition("chat", "block").sortWithinPartitions("chat", "block", "pos")
    return known.mapInArrow(_decoded(model), "chat long, block long, pos long, state long")


def turns(lines: DataFrame, states: DataFrame) -> DataFrame:
    """(chat, turn, role, n_lines, text) from lines and their states: a turn runs from an opening line to the next;
    markers and closing lines go, the rest is rendered canonically."""
    rows = lines.join(states, ["chat", "block", "pos"])
    rows = rows.withColumn("opens", (F.col("state") % 2 == 0).cast("long"))
    per_block = rows.groupBy("chat", "block").agg(F.sum("opens").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("chat").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))  # one row per block
    rows = rows.join(per_block.select("chat", "block", before.alias("n")), ["chat", "block"])
    number = F.sum("opens").over(Window.partitionBy("chat", "block").orderBy("pos")) + F.col("n") - 1
    plain = F.when(F.col("marker") != "", F.ltrim(F.substr("line", F.length("marker") + 1))).otherwise(F.col("line"))
    rows = rows.select("chat", number.alias("turn"), F.floor(F.col("state") / 2).cast("int").alias("r"), "block", "pos",
                       F.when(~F.col("line").rlike(END), F.when(F.col("opens") == 1, plain).otherwise(F.col("line"))).alias("line"))
    held = F.sort_array(F.collect_list(F.struct("block", "pos", "line")))
    out = rows.groupBy("chat", "turn").agg(F.min("r").alias("r"), F.count("*").alias("n_lines"), held.alias("held"))
    text = F.array_join(F.transform("held", lambda h: h["line"]), "\n")  # lines that went are null and left out
    role = F.element_at(F.array(*map(F.lit, ROLES)), F.col("r") + 1)
    body = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    return out.select("chat", "turn", role.alias("role"), "n_lines",
                      F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), body, F.lit("<|im_end|>")).alias("text"))


def parsed(rows: DataFrame, model: Model, chat: str, order: list[Column], text: str) -> DataFrame:
    """Canonical turns of raw transcripts: ``chat``, ``turn`` from 0, ``role``, ``n_lines`` and ``text``. ``rows``
    hold pieces of transcripts in the order of ``order``. Other columns are ignored."""
    lines = line_symbols(transcript_lines(rows, chat, order, text))
    return turns(lines, best_states(lines, model)).withColumnRenamed("chat", chat)


def fit(rows: DataFrame, chat: str, order: list[Column], text: str, role: str = "role") -> Model:
    """A model from pieces of transcripts that are a turn of a known role each; other roles and nulls are left
    out. All rows count."""
    known = rows.where(F.col(role).isin(*ROLES)).withColumn("_role", F.col(role))
    lines = line_symbols(transcript_lines(known, chat, order, text, ("_role",)))
    code = sum(F.when(F.col("_role") == r, 2 * i).otherwise(0) for i, r in enumerate(ROLES))
    lines = lines.withColumn("state", (code + (F.col("i") > 0).cast("int")).cast("int"))
    after = F.lag("state").over(Window.partitionBy("chat", "block").orderBy("pos"))
    lines = lines.withColumn("after", after).where("after is not null or block = 0")
    return count_model(lines)

"""Roles of transcript lines by a hidden Markov model, and canonical turns.

Each line of a transcript shows a speaker marker, or none, and a few features of its form. Hidden states
are the roles, each as the first line of a turn or a later one; Viterbi finds the most likely path. A long
conversation is cut into blocks. The best scores from each state before a block to each state at its
end form a small matrix; the matrices of a conversation are run through in order, one way for the
scores and back for the states at the borders, and then every block is decoded by itself.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidelake.operators.skew import numbered
from tidelake.session import stored

ROLES = ["system", "user", "assistant"]
STATES = 2 * len(ROLES)  # first line of a turn, later line
#: Rows of a conversation in one block.
BLOCK_ROWS = 512
#: Scores are log probabilities in millionths, so that sums are exact in any order.
UNIT = 1_000_000
#: What counts of markers begin with: speakers name themselves where a turn begins.
MARKER_PRIOR = 1_000.0

# What transcripts call the speakers.
MARKERS = {
    "system": ["system", "instruction", "instructions", "context"],
    "user": ["user", "human", "question", "q", "prompter", "customer", "client", "student", "usuario", "utilisateur", "nutzer", "benutzer"],
    "assistant": ["assistant", "ai", "bot", "answer", "a", "chatbot", "gpt", "model", "agent", "response", "asistente", "assistent"],
}
_ROLE_OF = {word: ROLES.index(role) for role, words in MARKERS.items() for word in words}
_MARK = re.compile(
    r"\s*(?:<\|(?:im_start\|>)?|\[|#{1,4}\s*|\*\*)?\s*(" + "|".join(sorted(_ROLE_OF, key=len, reverse=True)) + r")\s*(?:\*\*\s*:|:\s*\*\*|[:\]]|\|>|>\s|$)",
    re.IGNORECASE,
)
_ENDED = re.compile(r"\s*<\|(?:im_end|end|eot_id|endoftext)\|>\s*$")
_LIST = re.compile(r"\s*(?:[-*•]\s|\d+[.)]\s|```|\|)")

#: How many values each feature has: marker, first line of a row, length, question, list or code.
SHAPE = (len(ROLES) + 1, 2, 5, 2, 2)


def marker(line: str) -> tuple[int, str]:
    """(role or -1, the line without its marker)."""
    found = _MARK.match(line)
    if not found or (found.end() == len(line) and not re.search(r"[:\]>#*]", found.group())):
        return -1, line
    return _ROLE_OF[found.group(1).lower()], line[found.end() :].lstrip()


def features(line: str, first: bool) -> tuple[int, ...]:
    role, rest = marker(line)
    size = len(rest)
    return (
        role + 1,
        int(first),
        (size > 0) + (size > 40) + (size > 160) + (size > 640),
        int(rest.rstrip().endswith("?")),
        int(bool(_LIST.match(rest))),
    )


@dataclass
class Model:
    """Scores in millionths: ``first[s]``, ``move[s, t]``, and ``shows[f][s, value]`` per feature."""

    first: np.ndarray
    move: np.ndarray
    shows: list[np.ndarray]

    def emissions(self, seen: np.ndarray) -> np.ndarray:
        return sum(table[:, seen[:, f]].T for f, table in enumerate(self.shows))


#: Scores no path falls to by itself.
NEVER = -(1 << 60)


def _allowed() -> np.ndarray:
    """A turn goes on with its own later lines, and any turn may follow."""
    move = np.zeros((STATES, STATES), bool)
    move[:, ::2] = True
    for role in range(len(ROLES)):
        move[2 * role : 2 * role + 2, 2 * role + 1] = True
    return move


def _model(counts: dict[str, np.ndarray]) -> Model:
    allowed = _allowed()

    def scores(table: np.ndarray) -> np.ndarray:
        return np.rint(UNIT * np.log(table / table.sum(-1, keepdims=True))).astype(np.int64)

    first = np.where(np.arange(STATES) % 2 == 0, counts["first"] + 1.0, 1e-9)
    move = np.where(allowed, scores(np.where(allowed, counts["move"] + 1.0, 1e-9)), NEVER)
    shows = []
    for f, size in enumerate(SHAPE):
        table = counts["shows"][f] + 0.5
        if f == 0:
            table[:, 0] += 2 * MARKER_PRIOR
            for role in range(len(ROLES)):
                table[2 * role, role + 1] += MARKER_PRIOR
        shows.append(scores(table))
    return Model(np.where(np.arange(STATES) % 2 == 0, scores(first), NEVER), move, shows)


def _best(before: np.ndarray, move: np.ndarray, emit: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Scores at the last line and, per line, the best state before each state, the lowest on a tie."""
    back = []
    for line in emit:
        through = before[:, None] + move
        back.append(through.argmax(0))
        before = np.maximum(through.max(0) + line, NEVER)
    return before, back


def block_matrix(model: Model, seen: np.ndarray, opening: bool) -> np.ndarray:
    """Best score from each state before the block to each state at its end."""
    emit = model.emissions(seen)
    if opening:
        end, _ = _best(np.maximum(model.first + emit[0], NEVER), model.move, emit[1:])
        return np.tile(end, (STATES, 1))
    out = np.empty((STATES, STATES), np.int64)
    for s in range(STATES):
        out[s], _ = _best(np.where(np.arange(STATES) == s, 0, NEVER), model.move, emit)
    return out


def block_path(model: Model, seen: np.ndarray, opening: bool, start: int, end: int) -> list[int]:
    """The best states of a block between the two states at its borders."""
    emit = model.emissions(seen)
    if opening:
        _, back = _best(np.maximum(model.first + emit[0], NEVER), model.move, emit[1:])
    else:
        _, back = _best(np.where(np.arange(STATES) == start, 0, NEVER), model.move, emit)
    path = [end]
    for step in reversed(back if opening else back[1:]):
        path.append(int(step[path[-1]]))
    return path[::-1]


def _lines(text: str | None) -> list[str]:
    return ("" if text is None else text).split("\n")


def _encode(batches):
    """Features of all lines of each row, flattened."""
    for batch in batches:
        seen = [[v for i, x in enumerate(_lines(t)) for v in features(x, i == 0)] for t in batch.column("t").to_pylist()]
        yield pa.RecordBatch.from_pydict(
            {"c": batch.column("c"), "pos": batch.column("pos"), "role": batch.column("role"), "seen": pa.array(seen, pa.list_(pa.int8()))}
        )


def _count(batches):
    """Of each block with known roles: moves, first states and features, counted."""
    first, move = np.zeros(STATES), np.zeros((STATES, STATES))
    shows = [np.zeros((STATES, size)) for size in SHAPE]
    for batch in batches:
        for opening, roles, sizes, seen in zip(*(batch.column(c).to_pylist() for c in ("opening", "roles", "sizes", "seen"))):
            seen = np.array(seen).reshape(-1, len(SHAPE))
            states = [2 * ROLES.index(r) + (i > 0) if r in ROLES else -1 for r, n in zip(roles, sizes) for i in range(n)]
            if opening and states[0] >= 0:
                first[states[0]] += 1
            for a, b in zip(states, states[1:]):
                if a >= 0 and b >= 0:
                    move[a, b] += 1
            states = np.array(states)
            for f, table in enumerate(shows):
                np.add.at(table, (states[states >= 0], seen[states >= 0, f]), 1)
    flat = np.concatenate([first, move.ravel(), *[t.ravel() for t in shows]])
    yield pa.RecordBatch.from_pydict({"at": pa.array(range(len(flat)), pa.int32()), "n": pa.array(flat)})


def _blocks(rows: DataFrame) -> DataFrame:
    """One row per block, its rows in order; at most BLOCK_ROWS rows each."""
    block = F.floor((F.col("pos") - 1) / BLOCK_ROWS).alias("block")
    return rows.groupBy("c", block).agg(F.sort_array(F.collect_list(F.struct("pos", "role", "seen"))).alias("r")).select(
        "c",
        "block",
        (F.col("block") == 0).alias("opening"),
        F.col("r.role").alias("roles"),
        F.transform("r", lambda r: (F.size(r["seen"]) / len(SHAPE)).cast("int")).alias("sizes"),
        F.flatten("r.seen").alias("seen"),
    )


def fit(blocks: DataFrame) -> Model:
    """A model from blocks whose rows have known roles; without any, the priors alone."""
    rows = blocks.mapInArrow(_count, "at int, n double").groupBy("at").agg(F.sum("n").alias("n")).collect()
    size = STATES + STATES * STATES + STATES * sum(SHAPE)
    flat = np.zeros(size)
    for row in rows:
        flat[row["at"]] = row["n"]
    shows, at = [], STATES + STATES * STATES
    for width in SHAPE:
        shows.append(flat[at : at + STATES * width].reshape(STATES, width))
        at += STATES * width
    return _model({"first": flat[:STATES], "move": flat[STATES : STATES + STATES * STATES].reshape(STATES, STATES), "shows": shows})


def _scan(forward: bool):
    """Run through the blocks of a conversation in the order of the partition's rows.

    Forward, a block gets the scores of the states before it; backward, the states at its borders.
    """

    def run(batches):
        name, carry = object(), None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                matrix = np.array(row["matrix"], np.int64).reshape(STATES, STATES)
                if row["c"] != name:
                    name, carry = row["c"], np.zeros(STATES, np.int64) if forward else None
                if forward:
                    out.append(carry.tolist())
                    carry = np.maximum((carry[:, None] + matrix).max(0), NEVER)
                    carry = carry - carry.max()
                else:
                    scores = np.array(row["before"], np.int64)[:, None] + matrix
                    end = int(scores.max(0).argmax()) if carry is None else carry
                    carry = int(scores[:, end].argmax())
                    out.append([carry, end])
            yield batch.append_column("before" if forward else "borders", pa.array(out, pa.list_(pa.int64())))

    return run


def recover_roles(df: DataFrame, model: Model | None = None, known: str | None = None, conv: str = "conv_id",
                  turn: str = "turn", text: str = "text") -> DataFrame:
    """Turns of the transcripts in ``df``, with roles recovered from lines alone.

    Rows of a conversation follow ``turn``, then the text; each row may hold several turns, and a line
    with a speaker marker can begin one. Result, one row per turn: ``conv_id``, ``turn``, ``part`` (from
    0 within a row), ``role``, ``content`` (markers taken off) and ``rendered`` (``<|role|>`` line,
    content, ``<|end|>``). ``known`` names a column of roles to fit a model on where it isn't null;
    decoding never reads it. Null or empty texts are one empty line and get a role like others; rows
    with a null conversation form one conversation; repeated rows are kept; an empty table gives no
    rows. Of equally likely paths one is taken that is the same on every run.
    """
    kept = df.select(
        F.col(conv).alias("c"), F.col(turn).alias("turn"), F.col(text).alias("t"),
        (F.col(known) if known else F.lit(None)).cast("string").alias("role"),
    ).withColumn("order", F.struct(F.col("turn").isNull(), "turn", F.coalesce("t", F.lit("")), F.coalesce("role", F.lit(""))))
    rows = stored(numbered(kept, ["c"], ["order"], "pos").drop("order"))
    kind = rows.schema["c"].dataType.simpleString()
    coded = rows.select("c", "pos", "role", "t").mapInArrow(_encode, f"c {kind}, pos long, role string, seen array<byte>")
    blocks = stored(_blocks(coded))
    model = model or fit(blocks)

    def matrices(batches):
        for batch in batches:
            found = [
                block_matrix(model, np.array(seen).reshape(-1, len(SHAPE)), opening).ravel().tolist()
                for opening, seen in zip(batch.column("opening").to_pylist(), batch.column("seen").to_pylist())
            ]
            yield batch.select(["c", "block"]).append_column("matrix", pa.array(found, pa.list_(pa.int64())))

    def decode(batches):
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("opening", "sizes", "seen", "borders"))
            states = []
            for opening, sizes, seen, (start, end) in zip(*columns):
                path = block_path(model, np.array(seen).reshape(-1, len(SHAPE)), opening, start, end)
                ends = np.cumsum(sizes).tolist()
                states.append([path[a:b] for a, b in zip([0, *ends], ends)])
            kinds = pa.list_(pa.list_(pa.int32()))
            yield batch.select(["c", "block"]).append_column("states", pa.array(states, kinds))

    matrix = blocks.select("c", "block", "opening", "seen").mapInArrow(matrices, f"c {kind}, block long, matrix array<long>")
    # the rows of a scan are small, one per block, and no task holds more than one of them at a time
    ahead = matrix.repartition("c").sortWithinPartitions("c", "block").mapInArrow(
        _scan(True), f"c {kind}, block long, matrix array<long>, before array<long>"
    )
    behind = ahead.sortWithinPartitions("c", F.desc("block")).mapInArrow(
        _scan(False), f"c {kind}, block long, matrix array<long>, before array<long>, borders array<long>"
    )
    borders = behind.select(F.col("c").alias("bc"), F.col("block").alias("bb"), "borders")
    both = blocks.join(borders, F.col("c").eqNullSafe(F.col("bc")) & (F.col("block") == F.col("bb")))
    decoded = both.select("c", "block", "opening", "sizes", "seen", "borders").mapInArrow(
        decode, f"c {kind}, block long, states array<array<int>>"
    )
    states = decoded.select(F.col("c").alias("sc"), F.posexplode("states").alias("i", "states"), "block").select(
        "sc", (F.col("block") * BLOCK_ROWS + F.col("i") + 1).alias("sp"), "states"
    )
    named = rows.join(states, F.col("c").eqNullSafe(F.col("sc")) & (F.col("pos") == F.col("sp"))).select("c", "turn", "pos", "t", "states")

    def render(batches):
        for batch in batches:
            at, parts, roles, contents = [], [], [], []
            for i, (t, path) in enumerate(zip(batch.column("t").to_pylist(), batch.column("states").to_pylist())):
                turns: list[tuple[int, list[str]]] = []
                for n, (line, state) in enumerate(zip(_lines(t), path)):
                    line = _ENDED.sub("", line)
                    if n == 0 or state % 2 == 0:
                        turns.append((state // 2, []))
                    found, rest = marker(line)
                    turns[-1][1].append(rest if found >= 0 and not turns[-1][1] else line)
                for part, (role, lines) in enumerate(turns):
                    at.append(i)
                    parts.append(part)
                    roles.append(ROLES[role])
                    contents.append("\n".join(lines).strip())
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_pydict(
                {
                    "c": batch.column("c").take(take),
                    "turn": batch.column("turn").take(take),
                    "part": pa.array(parts, pa.int32()),
                    "role": pa.array(roles, pa.string()),
                    "content": pa.array(contents, pa.string()),
                    "rendered": pa.array([f"<|{r}|>\n{x}\n<|end|>" for r, x in zip(roles, contents)], pa.string()),
                }
            )

    of = named.schema["turn"].dataType.simpleString()
    return named.mapInArrow(render, f"c {kind}, turn {of}, part int, role string, content string, rendered string").select(
        F.col("c").alias(conv), F.col("turn").alias(turn), "part", "role", "content", "rendered"
    )

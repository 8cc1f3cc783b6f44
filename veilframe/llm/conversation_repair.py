"""Cheapest repair of a conversation's turns, by divide and conquer in linear space.

A conversation must read ``(s?(ua)+)?`` in the initials of its roles. Four states
say what has been written so far: nothing, the system turn, a user turn, an
assistant turn. Each row costs something to keep, to give another role or to
delete, and empty turns may be inserted before it; so a row is a small table of
moves between the states. Forward vectors hold the least cost of reaching each
state from the front, backward vectors the least cost from each state to the end.
Where the two meet in the middle of the conversation the cheapest crossing is
chosen, and both halves are solved in the same way: only eight numbers are held
per level, and no table of the whole conversation.

Ties go to the audit (the edits' initials in order) that is least in ASCII. A
crossing lies right behind a row's own edit, so no audit up to it is the
beginning of another, and forward vectors need the *rank* of their states' least
audits, not the audits.

A whole conversation is never held. Rows are dealt by ranges of (conversation,
turn) and cut into pieces; a piece is a table of moves like a row, so the same
procedure over pieces gives the state at each border of a conversation that
lies in several tasks, and the pieces are then solved apart. Only the audit is
put together, being one value, and the hash, which is streamed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.session import materialize

PIECE_ROWS = 4096
PIECE_CHARS = 2 << 20
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {SYSTEM: "system", USER: "user", ASSISTANT: "assistant"}
DELETE, INSERT, REROLE = 3, 2, 2
GONE = 0  # kind of a row that has to go; the others are 1 + 2 * initial + truncated
_INITIALS = "sua"
BLANKS = " \t\n\x0b\x0c\r"

# One row's or piece's moves: (from, to, cost, order among the moves of equal cost and the same start).
Moves = Sequence[tuple[int, int, int, object]]


def follows(state: int) -> int:
    """The only state an inserted or renamed turn can lead to."""
    return ASSISTANT if state == USER else USER


def _moves(kind: int) -> Moves:
    least: dict[tuple[int, int], tuple[int, str]] = {}

    def offer(start: int, end: int, cost: int, letters: str) -> None:
        least[start, end] = min(least.get((start, end), (cost, letters)), (cost, letters))

    for start in range(4):
        state = start
        for inserts in range(3):  # a third one would lead back to a state seen before
            cost, letters = INSERT * inserts, "I" * inserts
            offer(start, state, cost + DELETE, letters + "D")
            if kind != GONE:
                initial, cut = divmod(kind - 1, 2)
                offer(start, follows(state), cost + REROLE + cut, letters + "R")
                if initial == 0 and state == START:
                    offer(start, SYSTEM, cost + cut, letters + "K")
                elif initial in (1, 2) and follows(state) == (USER, ASSISTANT)[initial - 1]:
                    offer(start, follows(state), cost + cut, letters + "K")
            state = follows(state)
    return [(*ends, *best) for ends, best in least.items()]


MOVES = [_moves(kind) for kind in range(9)]
LETTERS = [{(a, b): letters for a, b, _, letters in moves} for moves in MOVES]
TAIL = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}


def kind_of(role: str, truncated: bool) -> int:
    at = _INITIALS.find(role[:1]) if role else -1
    return 1 + 2 * (at if at >= 0 else 3) + truncated


def forward(steps: Sequence[Moves], start: int) -> dict[int, tuple[int, int]]:
    """By state: least cost from ``start``, and the rank of its least audit among the states."""
    at = {start: (0, 0)}
    for moves in steps:
        best: dict[int, tuple] = {}
        for a, b, cost, order in moves:
            if a in at:
                new = at[a][0] + cost, at[a][1], order
                if b not in best or new < best[b]:
                    best[b] = new
        ranked = sorted(best, key=lambda s: best[s][1:])
        at = {s: (best[s][0], rank) for rank, s in enumerate(ranked)}
    return at


def backward(steps: Sequence[Moves], end: int) -> dict[int, int]:
    """By state: least cost from it to ``end``."""
    at = {end: 0}
    for moves in reversed(steps):
        best: dict[int, int] = {}
        for a, b, cost, _ in moves:
            if b in at and at[b] + cost < best.get(a, at[b] + cost + 1):
                best[a] = at[b] + cost
        at = best
    return at


def last_state(steps: Sequence[Moves]) -> int:
    """Where the cheapest repair of the whole stands before its tail."""
    at = forward(steps, START)
    return min(at, key=lambda s: (at[s][0] + INSERT * len(TAIL[s]), at[s][1]))


def crossings(steps: Sequence[Moves], start: int, end: int) -> list[int]:
    """The state behind each step on the audit-least cheapest way."""
    out, todo = [], [(0, len(steps), start, end)]
    while todo:
        low, high, a, b = todo.pop()
        if high - low == 1:
            out.append(b)
        elif high > low:
            mid = (low + high) // 2
            front, back = forward(steps[low:mid], a), backward(steps[mid:high], b)
            cross = min(front.keys() & back.keys(), key=lambda s: (front[s][0] + back[s], front[s][1]))
            todo += [(mid, high, cross, b), (low, mid, a, cross)]
    return out


def edits(kinds: bytes, start: int = START, end: int | None = None) -> tuple[list[str], int]:
    """The edits of each row (inserts before it, then its own), and the state behind the last."""
    steps = [MOVES[k] for k in kinds]
    end = last_state(steps) if end is None else end
    states = [start, *crossings(steps, start, end)]
    return [LETTERS[k][a, b] for k, a, b in zip(kinds, states, states[1:])], end


# -- damage ----------------------------------------------------------------------------------------------------------


def damage(df: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", every: int = 20) -> DataFrame:
    """(conv_id, turn, role, text, copies): rows with repeatable faults, told by crc32 of ``conv:turn`` modulo ``every``.

    0 drops the row (no copies), 1 empties its text, 2 removes its ``.!?``, 3 repeats
    it, 4 makes its role user. A null counts as one space.
    """
    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    code = F.crc32(F.concat_ws(":", spaced(conv_col), spaced(turn_col))) % every
    text = F.when(code == 1, "").when(code == 2, F.regexp_replace(spaced(text_col), "[.!?]", "")).otherwise(spaced(text_col))
    return df.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.when(code == 4, "user").otherwise(spaced(role_col)).alias("role"), text.alias("text"),
        F.when(code == 0, 0).when(code == 3, 2).otherwise(1).alias("copies"),
    )


# -- pieces ----------------------------------------------------------------------------------------------------------

_PIECE = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int64()), ("nth", pa.int64()), ("closed", pa.bool_()), ("kinds", pa.binary()), ("moves", pa.list_(pa.int64())),
    ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
    ("illegal", pa.int64()), ("first", pa.string()), ("last", pa.string()), ("low", pa.int64()), ("high", pa.int64()), ("turns", pa.int64()),
])
_PIECE_SQL = (
    "conv_id long, part long, nth long, closed boolean, kinds binary, moves array<long>, roles array<string>, texts array<string>, blank long, duplicate long, "
    "truncated long, illegal long, first string, last string, low long, high long, turns long"
)
OK, BLANK, LATER, TRUNCATED = range(4)


def _legal(a: str, b: str) -> bool:
    return a + b in ("su", "ua", "au")


class _Piece:
    def __init__(self, most: int, conv, begins: bool, alone: bool = True):
        self.most, self.conv, self.begins, self.alone = most, conv, begins, alone  # begins: the conversation starts in this task
        self.kinds, self.roles, self.texts, self.chars = bytearray(), [], [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.low = self.high = None

    def full(self) -> bool:
        return len(self.kinds) >= self.most or self.chars >= PIECE_CHARS

    def add(self, turn, role: str, text: str, copies: int, fault: int) -> int:
        """Takes copies of a row until the piece is full; the number it took."""
        copies = min(copies, self.most - len(self.kinds))
        initial = role[:1]
        self.illegal += (copies - 1) + (self.first is not None and not _legal(self.last, initial))
        self.first, self.last = initial if self.first is None else self.first, initial
        if turn is not None and turn != self.high:
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        if fault == BLANK:
            self.blank += copies
        elif fault == LATER:
            self.duplicate += copies
        else:
            self.duplicate += copies - 1
            self.truncated += fault == TRUNCATED
            self.kinds.append(kind_of(role, fault == TRUNCATED))
            self.roles.append(role)
            self.texts.append(text)
            self.chars += len(text)
        self.kinds.extend(bytes(copies - (fault in (OK, TRUNCATED))))
        return copies

    def row(self, part: int, nth: int, ends: bool) -> tuple:
        closed, moves = self.begins and ends and self.alone, []
        if not closed:
            steps = [MOVES[k] for k in self.kinds]
            moves = [x for s in range(4) for e, (cost, rank) in forward(steps, s).items() for x in (s, e, cost, rank)]
        return (
            self.conv, part, nth, closed, bytes(self.kinds), moves, self.roles, self.texts, self.blank, self.duplicate, self.truncated, self.illegal,
            self.first, self.last, self.low, self.high, self.turns,
        )


def _cut(most: int):
    """Rows of a range, in order, as pieces. The first and last conversation may go on in other tasks."""

    def run(batches):
        part, nth, piece = TaskContext.get().partitionId(), 0, None
        held, chars = [], 0

        def close(ends: bool) -> None:
            nonlocal nth, chars
            held.append(piece.row(part, nth, ends))
            nth, chars = nth + 1, chars + piece.chars

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), _PIECE)], schema=_PIECE)

        for rows in batches:
            for conv, turn, role, text, copies, fault in zip(*[rows.column(n).to_pylist() for n in ("conv_id", "turn", "role", "text", "copies", "fault")]):
                if piece is None or piece.conv != conv:
                    if piece is not None:
                        close(True)
                    piece = _Piece(most, conv, piece is not None)
                first = True
                while copies:
                    if piece.full():
                        piece.alone = False
                        close(False)
                        piece = _Piece(most, conv, piece.begins, alone=False)
                    took = piece.add(turn, role, text, copies, fault if first or fault == BLANK else LATER)
                    copies, first = copies - took, False
                if chars >= PIECE_CHARS or len(held) >= 1024:
                    yield batch()
                    held, chars = [], 0
        if piece is not None:
            close(False)
            yield batch()

    return run


def pieces(df: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", copies_col: str | None = None) -> DataFrame:
    """The written table of pieces."""
    copies = F.lit(1) if copies_col is None else F.coalesce(F.col(copies_col), F.lit(0))

    def own(column: Column, otherwise: Column) -> Column:  # absent rows only say that the conversation exists
        return F.when(F.col("copies") > 0, column).otherwise(otherwise)

    rows = df.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col), F.lit(" ")).alias("text"), copies.cast("long").alias("copies"),
    )
    empty = F.lit("")
    rows = rows.select("conv_id", own(F.col("turn"), F.lit(None)).alias("turn"), own(F.col("role"), empty).alias("role"), own(F.col("text"), empty).alias("text"), "copies")
    # What a conversation says again is told from digests alone: a short table, and of known size before the texts are moved.
    said = rows.where("copies > 0").groupBy("conv_id", "role", F.unhex(F.sha2("text", 256)).alias("d")).agg(
        F.count("*").alias("n"), F.min("turn").alias("since"), F.max(F.col("turn").isNull()).alias("without")
    ).where("n > 1")
    said = materialize(said.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), "d", "since", "without"), "said")
    # Equal rows of a turn become one row with a count before anything is sorted.
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies")).withColumn("digest", F.unhex(F.sha2("text", 256)))
    rows = rows.join(said, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d")), "left")
    later = F.col("turn").isNotNull() & (F.col("without") | (F.col("turn") > F.col("since")))
    end = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    fault = F.when(end == "", BLANK).when(F.coalesce(later, F.lit(False)), LATER).when(~end.isin(".", "!", "?"), TRUNCATED).otherwise(OK)
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.col("role").asc(), F.col("digest").asc()]
    dealt = rows.select("conv_id", "turn", "role", "digest", "text", "copies", fault.alias("fault")).repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(dealt.drop("digest").mapInArrow(_cut(PIECE_ROWS), _PIECE_SQL), "pieces")


def _borders(batches):
    """The state before and behind each piece of the conversations that lie in several."""
    names = ["part", "nth", "start", "end", "final"]

    def solved(held: list) -> pa.RecordBatch:
        steps = [list(zip(*[iter(moves)] * 4)) for _, _, moves in held]
        states = [START, *crossings(steps, START, last_state(steps))]
        columns = [[h[0] for h in held], [h[1] for h in held], states[:-1], states[1:]]
        return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns], pa.array([i == len(held) - 1 for i in range(len(held))])], names=names)

    current, held = None, []
    for batch in batches:
        for conv, *piece in zip(*[batch.column(n).to_pylist() for n in ("conv_id", "part", "nth", "moves")]):
            if held and conv != current:
                yield solved(held)
                held = []
            current = conv
            held.append(piece)
    if held:
        yield solved(held)


def solved_pieces(df: DataFrame, **columns) -> tuple[DataFrame, DataFrame]:
    """Pieces with the states at their ends: those of conversations in one piece, and the others, in order."""
    cut = pieces(df, **columns)
    closed = cut.where("closed").withColumns({"start": F.lit(0).cast("long"), "end": F.lit(None).cast("long"), "final": F.lit(True)}).drop("moves")
    split = cut.where("not closed")
    slim = split.select("conv_id", "part", "nth", "moves").repartition("conv_id").sortWithinPartitions("conv_id", "part", "nth")
    borders = slim.mapInArrow(_borders, "part long, nth long, start long, end long, final boolean")
    joined = split.drop("moves").join(borders, ["part", "nth"]).select(*closed.columns)
    return closed, joined.repartition("conv_id").sortWithinPartitions("conv_id", "part", "nth")


def _walk(piece: dict) -> Iterator[tuple[str, str | None, str | None]]:
    """(edit, role, text) of every edit of a piece; no role where a row goes."""
    kinds, state, said = piece["kinds"], piece["start"], 0
    letters, end = edits(kinds, state, piece["end"])
    for kind, own in zip(kinds, letters):
        for letter in own:
            if letter == "D":
                yield "D", None, None
            elif letter == "I":
                state = follows(state)
                yield "I", ROLES[state], ""
            elif letter == "R":
                state = follows(state)
                yield "R", ROLES[state], piece["texts"][said]
            else:
                role = piece["roles"][said]
                state = SYSTEM if role[0] == "s" else follows(state)
                yield "K", role, piece["texts"][said]
        said += kind != GONE
    for _ in TAIL[end] if piece["final"] else "":
        state = follows(state)
        yield "I", ROLES[state], ""


def _price(piece: dict, audit: str) -> int:
    own = [x for x in audit if x != "I"]
    return audit.count("D") * DELETE + (len(audit) - len(own)) * INSERT + audit.count("R") * REROLE + sum(
        x != "D" and kind != GONE and (kind - 1) % 2 for x, kind in zip(own, piece["kinds"])
    )


class _Digest:
    """What is told of a conversation; takes its pieces in order, holds no text."""

    def __init__(self, conv):
        self.conv, self.hash, self.lines, self.audit, self.cost = conv, hashlib.sha256(), 0, [], 0
        self.counts, self.last, self.low, self.high, self.turns = [0] * 4, None, None, None, 0

    def add(self, piece: dict) -> None:
        audit = []
        for letter, role, text in _walk(piece):
            audit.append(letter)
            if role is not None:
                self.hash.update((("\n" if self.lines else "") + f"{role}:{text}").encode())
                self.lines += 1
        self.audit.append("".join(audit))
        self.cost += _price(piece, self.audit[-1])
        self.counts = [a + piece[n] for a, n in zip(self.counts, ("blank", "duplicate", "truncated", "illegal"))]
        if piece["first"] is not None:
            self.counts[3] += self.last is not None and not _legal(self.last, piece["first"])
            self.last = piece["last"]
        if piece["low"] is not None:
            self.turns += piece["turns"] - (piece["low"] == self.high)
            self.low, self.high = piece["low"] if self.low is None else self.low, piece["high"]

    def row(self) -> tuple:
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.turns, 2**63 - 1)
        return (self.conv, gaps, *self.counts, self.cost, "".join(self.audit), self.hash.hexdigest())


_TOLD = pa.schema([
    ("conv_id", pa.int64()), *[(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string()), ("repaired_sha256", pa.string()),
])


def _conversations(batches) -> Iterator[tuple[object, dict]]:
    """(conversation, piece) in the order of the rows, one piece at a time."""
    for batch in batches:
        for i in range(batch.num_rows):
            piece = batch.slice(i, 1).to_pylist()[0]
            yield piece["conv_id"], piece


def _tell(batches):
    def told(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _TOLD)], schema=_TOLD)

    current, rows = None, []
    for conv, piece in _conversations(batches):
        if current is None or current.conv != conv:
            if current is not None:
                rows.append(current.row())
            current = _Digest(conv)
            if len(rows) >= 1024:
                yield told(rows)
                rows = []
        current.add(piece)
    if current is not None:
        yield told([*rows, current.row()])


def repair(df: DataFrame, **columns) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows are taken by turn, nulls first; rows of one turn by role, then by the
    SHA-256 of the text. ``copies_col`` may say how often a row stands; a
    conversation of which no row stands has zeros, an empty audit and the hash of
    nothing. A null role or text counts as one space, so a null text is blank;
    rows without a conversation id are one conversation. Texts of any length are
    taken whole; repeated rows are duplicates; other columns are ignored, an empty
    table gives no rows. Gaps beyond a long count as the largest long.
    """
    closed, split = solved_pieces(df, **columns)
    schema = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    return closed.mapInArrow(_tell, schema).unionByName(split.mapInArrow(_tell, schema))


_EDIT = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])


def _edit_rows(batches):
    current, place, rows, chars = object(), 0, [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _EDIT)], schema=_EDIT)

    for conv, piece in _conversations(batches):
        if conv != current:
            current, place = conv, 0
        for letter, role, text in _walk(piece):
            rows.append((conv, place, letter, role, text))
            place, chars = place + 1, chars + len(text or "")
            if len(rows) >= 4096 or chars >= PIECE_CHARS:
                yield batch()
                rows, chars = [], 0
    if rows:
        yield batch()


def repaired_turns(df: DataFrame, **columns) -> DataFrame:
    """One row per edit of ``repair``: conv_id, place (from 0), edit (K, R, D or I), and the turn's new role and text (null for D)."""
    closed, split = solved_pieces(df, **columns)
    schema = "conv_id long, place long, edit string, role string, text string"
    return closed.mapInArrow(_edit_rows, schema).unionByName(split.mapInArrow(_edit_rows, schema))

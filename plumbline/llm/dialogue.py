"""Conversation repair: the cheapest edits by min-plus matrices over a grammar of the rows' symbols."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cmp_to_key
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import join_groups, quoted, store

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Symbols of rows: must go; kept rows by the initial of their role, other initials as ``o``; truncated ones in capitals.
SYMBOLS = "XsuaoSUAO"
#: What a repaired conversation may look like so far: nothing, after a system, a user, an assistant row.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: Where a row of an initial, or an inserted one, leads to.
MOVES = {"s": {NOTHING: SYSTEM}, "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
ENDS = (NOTHING, ASSISTANT)
#: Symbols of a piece of a conversation, and symbols that a task holds at once.
PIECE, SYMBOLS_AT_ONCE = 1 << 15, 1 << 16
#: A pair becomes a rule while it stands in this many places at least.
LEAST_USES = 16
#: Rules that a task remembers from one group of conversations to the next.
REMEMBERED_RULES = 1 << 16
BLANKS = " \t\n\x0b\f\r"

# A rope is an audit text: a str, or a pair of ropes with its length. A matrix maps (from, to) to (cost, rope).
Rope = str | tuple
Matrix = dict[tuple[int, int], tuple[int, Rope]]


def _length(rope: Rope) -> int:
    return len(rope) if isinstance(rope, str) else rope[2]


def _tied(a: Rope, b: Rope) -> Rope:
    if not _length(a):
        return b
    return a if not _length(b) else (a, b, _length(a) + _length(b))


def flat(rope: Rope) -> str:
    """The text of a rope."""
    out, waiting = [], [rope]
    while waiting:
        top = waiting.pop()
        if isinstance(top, str):
            out.append(top)
        else:
            waiting += (top[1], top[0])
    return "".join(out)


def _order(a: Rope, b: Rope) -> int:
    """Compare two ropes as texts; what both share as one object is not looked at."""
    left, right = [a], [b]
    while left and right:
        x, y = left.pop(), right.pop()
        if x is y:
            continue
        if isinstance(x, str) and isinstance(y, str):
            n = min(len(x), len(y))
            if x[:n] != y[:n]:
                return -1 if x[:n] < y[:n] else 1
            if len(x) > n:
                left.append(x[n:])
            if len(y) > n:
                right.append(y[n:])
        elif isinstance(y, str) or (not isinstance(x, str) and x[2] >= y[2]):
            left += (x[1], x[0])
            right.append(y)
        else:
            right += (y[1], y[0])
            left.append(x)
    return bool(left) - bool(right)


def _better(a: tuple[int, Rope], b: tuple[int, Rope] | None) -> bool:
    return b is None or a[0] < b[0] or (a[0] == b[0] and _order(a[1], b[1]) < 0)


def product(a: Matrix, b: Matrix) -> Matrix:
    """Min-plus product: the cheapest way through both, ties by the least audit.

    Edits over the same rows at the same cost are never one the beginning of another (they would differ in inserted
    rows at the end alone, which cost), so the least audit of a whole has the least audits of its parts.
    """
    out: Matrix = {}
    for (i, k), (cost, rope) in a.items():
        for j in range(4):
            if (k, j) in b:
                more, tail = b[k, j]
                total = cost + more
                if (i, j) not in out or total <= out[i, j][0]:
                    found = total, _tied(rope, tail)
                    if _better(found, out.get((i, j))):
                        out[i, j] = found
    return out


def _inserts() -> Matrix:
    """Inserted rows between two others."""
    found: Matrix = {(i, i): (0, "") for i in range(4)}
    step = {(i, j): (INSERT, "I") for kind in "ua" for i, j in MOVES[kind].items()}
    for _ in range(4):
        wider = product(found, {**step, **{(i, i): (0, "") for i in range(4)}})
        found = wider
    return found


def _row(symbol: str) -> Matrix:
    """One row's edits, after any inserted rows before it."""
    edits: Matrix = {(i, i): (DELETE, "D") for i in range(4)}
    if symbol != "X":
        extra = TRUNCATED if symbol.isupper() else 0
        for cost, letter, kinds in ((KEEP, "K", symbol.lower()), (REROLE, "R", "ua")):
            for kind in kinds:
                for i, j in MOVES.get(kind, {}).items():
                    if _better((cost + extra, letter), edits.get((i, j))):
                        edits[i, j] = cost + extra, letter
    return product(_inserts(), edits)


ROWS = [_row(symbol) for symbol in SYMBOLS]
TAIL = _inserts()


def grammar(sequences: list[np.ndarray], least: int = LEAST_USES) -> tuple[list[tuple[int, int]], list[np.ndarray]]:
    """Re-Pair: rules ``(left, right)`` numbered from ``len(SYMBOLS)`` on, and the sequences written with them.

    The most frequent pair of neighbours, counted over all sequences, becomes a new symbol, until no
    pair stands in ``least`` places. In a run of one symbol every other pair counts.
    """
    rules: list[tuple[int, int]] = []
    sizes = np.array([len(s) for s in sequences], np.int64)
    text = np.concatenate([np.empty(0, np.int64), *sequences]).astype(np.int64)
    owner = np.repeat(np.arange(len(sequences)), sizes)
    while len(text) > 1:
        width = len(SYMBOLS) + len(rules)
        codes, inside = text[:-1] * width + text[1:], owner[:-1] == owner[1:]
        inside &= ~_second_of_run(codes, inside)
        if not inside.any():
            break
        kinds, uses = np.unique(codes[inside], return_counts=True)
        top = int(np.argmax(uses))
        if uses[top] < least:
            break
        places = np.flatnonzero(inside & (codes == kinds[top]))
        rules.append((int(kinds[top]) // width, int(kinds[top]) % width))
        text[places] = width
        stay = np.ones(len(text), bool)
        stay[places + 1] = False
        text, owner = text[stay], owner[stay]
    return rules, np.split(text, np.searchsorted(owner, np.arange(1, len(sequences))))


def _second_of_run(codes: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Places whose pair overlaps the equal pair before it, every other one from the start of a run."""
    again = np.zeros(len(codes), bool)
    again[1:] = (codes[1:] == codes[:-1]) & inside[1:] & inside[:-1]
    starts = np.maximum.accumulate(np.where(again, 0, np.arange(len(codes))))
    return (np.arange(len(codes)) - starts) % 2 == 1


class Rules:
    """Matrices of symbols and rules, kept by the pair of matrices that a rule joins."""

    def __init__(self):
        self.known: dict[tuple[int, int], tuple[Matrix, Matrix, Matrix]] = {}

    def joined(self, a: Matrix, b: Matrix) -> Matrix:
        key = id(a), id(b)
        if key not in self.known:
            if len(self.known) >= REMEMBERED_RULES:
                self.known.clear()
            self.known[key] = a, b, product(a, b)  # the parts stay, so that their ids do
        return self.known[key][2]

    def solved(self, sequences: list[str]) -> list[Matrix]:
        """One matrix per sequence of symbols, each rule of their common grammar evaluated once, from below."""
        table = np.full(128, -1, np.int64)
        table[[ord(s) for s in SYMBOLS]] = range(len(SYMBOLS))
        distinct = list(dict.fromkeys(sequences))
        rules, written = grammar([table[np.frombuffer(s.encode(), np.uint8)] for s in distinct])
        matrices = list(ROWS)
        for left, right in rules:
            matrices.append(self.joined(matrices[left], matrices[right]))
        found = {}
        for sequence, symbols in zip(distinct, written):
            whole: Matrix = {(i, i): (0, "") for i in range(4)}
            for k, symbol in enumerate(symbols.tolist()):
                whole = matrices[symbol] if k == 0 else product(whole, matrices[symbol])
            found[sequence] = whole
        return [found[s] for s in sequences]


def best(whole: Matrix) -> tuple[int, str]:
    """Cost and audit of a conversation from the product of its rows."""
    ways = product({(NOTHING, j): cell for (i, j), cell in whole.items() if i == NOTHING}, TAIL)
    cells = [ways[NOTHING, end] for end in ENDS if (NOTHING, end) in ways]
    cost, rope = min(cells, key=cmp_to_key(lambda a, b: -1 if _better(a, b) else 1))
    return cost, flat(rope)


COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")
PIECES = ("key string, part int, number long, low long, high long, first string, last string, "
          + ", ".join(f"{name} long" for name in COUNTS) + ", costs array<long>, audits array<string>")
PLAN = "key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_LEGAL = {"su", "ua", "au"}
_CELLS = [(i, j) for i in range(4) for j in range(4)]


class _Piece:
    """Neighbouring rows of a conversation."""

    def __init__(self, key: str, part: int, number: int):
        self.key, self.part, self.number = key, part, number
        self.symbols, self.size = [], 0
        self.low = self.high = self.first = self.last = None
        self.count = dict.fromkeys(COUNTS, 0)

    def turn(self, turn: int | None) -> None:
        if turn is not None:
            if self.low is None:
                self.low = turn
            self.count["turns"] += turn != self.high
            self.high = turn

    def rows(self, initial: str, fault: str, times: int) -> None:
        """Equal rows of one turn: where the first is whole, the others repeat it."""
        if self.last is None:
            self.first = initial
        elif self.last + initial not in _LEGAL:
            self.count["illegal"] += 1
        self.last = initial
        self.count["illegal"] += times - 1
        if fault in ("blank", "duplicate"):
            self.count[fault] += times
            self.symbols.append("X" * times)
        else:
            letter = initial if initial in MOVES else "o"
            self.count["truncated"] += fault == "truncated"
            self.count["duplicate"] += times - 1
            self.symbols.append((letter.upper() if fault == "truncated" else letter) + "X" * (times - 1))
        self.size += times


def _solved(rules: Rules, pieces: list[_Piece]) -> pa.RecordBatch:
    matrices = rules.solved(["".join(p.symbols) for p in pieces])
    cells = [[m.get(at) for at in _CELLS] for m in matrices]
    columns = [[getattr(p, name) for p in pieces] for name in ("key", "part", "number", "low", "high", "first", "last")]
    columns += [[p.count[name] for p in pieces] for name in COUNTS]
    columns += [[[c and c[0] for c in row] for row in cells], [[c and flat(c[1]) for c in row] for row in cells]]
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), *[pa.int64()] * len(COUNTS),
             pa.list_(pa.int64()), pa.list_(pa.string())]
    names = ["key", "part", "number", "low", "high", "first", "last", *COUNTS, "costs", "audits"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _read_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive by conversation and turn; every conversation becomes one piece, a long one several."""
    rules, held, size, piece, number = Rules(), [], 0, None, 0
    for batch in batches:
        for key, turn, initial, fault, times, part in zip(*(c.to_pylist() for c in batch.columns)):
            if piece is None or piece.key != key or piece.size >= PIECE:
                if piece is not None:
                    held.append(piece)
                    size += piece.size + 1
                    if size >= SYMBOLS_AT_ONCE:
                        yield _solved(rules, held)
                        held, size = [], 0
                piece, number = _Piece(key, part, number), number + 1
            while times:
                piece.turn(turn)
                some = min(times, PIECE)
                piece.rows(initial, fault, some)
                fault, times = ("blank" if fault == "blank" else "duplicate"), times - some
                if times:
                    held.append(piece)
                    yield _solved(rules, held)
                    held, size = [], 0
                    piece, number = _Piece(key, part, number), number + 1
    if piece is not None:
        yield _solved(rules, [*held, piece])


def _join_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces arrive in their order; the way from the start through all so far is all that is kept."""
    def finished(so_far):
        cost, audit = best(so_far["ways"])
        gaps = 0 if so_far["high"] is None else so_far["high"] - so_far["low"] + 1 - so_far["turns"]
        return (so_far["key"], gaps, *[so_far[name] for name in COUNTS[:4]], cost, audit)

    def rows(found):
        kinds = [pa.string(), *[pa.int64()] * 6, pa.string()]
        names = ["key", "gaps", *COUNTS[:4], "cost", "audit"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=names)

    so_far, out = None, []
    for batch in batches:
        for row in batch.to_pylist():
            matrix = {at: (c, a) for at, c, a in zip(_CELLS, row["costs"], row["audits"]) if c is not None}
            if so_far is None or so_far["key"] != row["key"]:
                if so_far is not None:
                    out.append(finished(so_far))
                    if len(out) >= 4096:
                        yield rows(out)
                        out = []
                so_far = {**row, "ways": {at: cell for at, cell in matrix.items() if at[0] == NOTHING}}
                continue
            so_far["ways"] = product(so_far["ways"], matrix)
            for name in COUNTS:
                so_far[name] += row[name]
            if row["low"] is not None:
                so_far["turns"] -= row["low"] == so_far["high"]
                so_far["low"] = row["low"] if so_far["low"] is None else so_far["low"]
                so_far["high"] = row["high"]
            if row["first"] is not None:
                so_far["illegal"] += so_far["last"] is not None and so_far["last"] + row["first"] not in _LEGAL
                so_far["last"] = row["last"]
    if so_far is not None:
        out.append(finished(so_far))
    if out:
        yield rows(out)


def damaged(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows ``(conv, turn, role, text, times)`` as a fixed rule damages them, for tests of the repair.

    ``crc32('conv:turn') % 20`` is 0: the row goes (``times`` 0); 1: its text is emptied; 2: its end marks go; 3: it stands
    twice; 4: its role is ``user``. A null is one space in the rule, in roles and in texts.
    """
    spaced = [F.coalesce(quoted(c).cast("string"), F.lit(" ")) for c in (conv, turn)]
    rule = F.crc32(F.concat_ws(":", *spaced).cast("binary")) % 20
    kind = F.col("kind")
    rows = conversations.select(
        quoted(conv).alias("conv"), quoted(turn).alias("turn"), quoted(role).alias("role"), quoted(text).alias("text"), rule.alias("kind"))
    spaced = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text")]
    return rows.select(
        "conv", F.col("turn").cast("long").alias("turn"), F.when(kind == 4, "user").otherwise(spaced[0]).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(spaced[1], ".!?", "")).otherwise(spaced[1]).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("times"))


def as_rows(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A table of turns as the rows that ``repair`` takes, each once; null roles and texts are one space."""
    return conversations.select(
        quoted(conv).alias("conv"), quoted(turn).cast("long").alias("turn"),
        *[F.coalesce(quoted(c).cast("string"), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text"))],
        F.lit(1).cast("long").alias("times"))


def _keyed(rows: DataFrame) -> DataFrame:
    """Each row with its conversation as a text key, and 128 bits for conversation, role and text."""
    key = F.coalesce(F.concat(F.lit(":"), F.col("conv").cast("string")), F.lit("-"))
    cells = F.concat(F.length(key), F.lit(":"), key, F.length("role"), F.lit(":"), F.col("role"), F.col("text"))
    return rows.withColumn("key", key).withColumn("digest", F.unhex(F.md5(cells)))


#: The order of a conversation's rows: by turn, nulls first; rows of one turn by role, the start of the text, and a digest of it.
PLACE = ["turn", "tie", "digest"]
_TIE_TYPE = "struct<role:string,start:string>"


def _tie() -> Column:
    return F.struct(F.substring("role", 1, 64).alias("role"), F.substring("text", 1, 64).alias("start"))


def plans(rows: DataFrame) -> DataFrame:
    """Per conversation of ``rows`` ``(conv, turn, role, text, times)``: ``key``, counts of faults, ``cost`` and ``audit``.

    Only small rows are dealt: equal rows are counted before the shuffle, and a range partitioning by
    conversation and place cuts a long conversation wherever a partition ends. A task writes its pieces of
    conversations with one grammar and evaluates each rule once. The pieces of a conversation are multiplied in order.
    """
    present = F.col("times") > 0
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = F.when(F.length(bare) == 0, "blank").when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "truncated").otherwise("")
    small = _keyed(rows).select(
        "key", F.when(present, F.col("turn")).alias("turn"), F.when(present, _tie()).alias("tie"),
        F.when(present, F.col("digest")).otherwise(F.unhex(F.md5("key"))).alias("digest"), F.when(present, F.substring("role", 1, 1)).alias("initial"),
        F.when(present, fault).alias("fault"), "times")
    small = store(small.groupBy("key", "turn", "tie", "digest", "initial", "fault").agg(F.sum("times").alias("times")), "rows")
    place = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    firsts = (small.where(present).groupBy("digest").agg(F.min(place).alias("first"), F.count("*").alias("places"))
              .where("places > 1"))
    first = F.col("first.turn")
    later = F.when(F.col("first").isNotNull() & ~first.eqNullSafe(F.col("turn")) & (F.col("fault") != "blank"), "duplicate")
    known = join_groups(small, firsts, ["digest"], "places", max(1, small.count()), "left")
    told = known.select("key", "turn", "initial", F.coalesce(later, "fault").alias("fault"), "times", "tie", "digest")
    dealt = told.repartitionByRange("key", *PLACE).sortWithinPartitions("key", *PLACE)
    pieces = dealt.select("key", "turn", "initial", "fault", "times", F.spark_partition_id().alias("part"))
    pieces = pieces.mapInArrow(_read_pieces, PIECES)
    return pieces.repartition("key").sortWithinPartitions("key", "part", "number").mapInArrow(_join_pieces, PLAN)


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A conversation's audit comes first, then its rows in order; what stays of them goes out, with the inserted ones."""
    names = ["key", "position", "edit", "role", "text"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
    audit, at, position, after = "", 0, 0, None
    for batch in batches:
        out: list[tuple] = []

        def put(key, edit, role, text):
            nonlocal position, after
            out.append((key, position, edit, role, text))
            position, after = position + 1, role[:1]

        def inserted(key):
            nonlocal at
            while at < len(audit) and audit[at] == "I":
                at += 1
                put(key, "insert", "assistant" if after == "u" else "user", "")

        for key, found, role, text, times in zip(*(c.to_pylist() for c in batch.columns)):
            if found is not None:
                audit, at, position, after = found, 0, 0, None
                inserted(key)
                continue
            for _ in range(times):
                edit, at = audit[at], at + 1
                if edit == "K":
                    put(key, "keep", role, text)
                elif edit == "R":
                    put(key, "rerole", "assistant" if after == "u" else "user", text)
                inserted(key)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 5, kinds)], names=names)


def _in_order(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The audit of each conversation and behind it its rows, one conversation after another in a partition."""
    audits = found.select("key", "audit", F.lit(None).cast("long").alias("turn"), F.lit(None).cast(_TIE_TYPE).alias("tie"),
                          F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("string").alias("role"),
                          F.lit(None).cast("string").alias("text"), F.lit(0).cast("long").alias("times"))
    present = _keyed(rows.where("times > 0"))
    present = present.select("key", F.lit(None).cast("string").alias("audit"), "turn", _tie().alias("tie"), "digest", "role", "text", "times")
    behind = F.col("audit").isNull()
    return (audits.unionByName(present).repartition("key").sortWithinPartitions("key", behind, *PLACE)
            .select("key", "audit", "role", "text", "times"))


def repaired_rows(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired conversations: ``key``, ``position`` from 0, ``edit``, ``role`` and ``text``.

    A conversation's rows pass through one task in order, one at a time; none is collected.
    """
    return _in_order(rows, found).mapInArrow(_edited, "key string, position long, edit string, role string, text string")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of ``role:text`` lines per conversation; the rows of one stand together in order."""
    key = state = None
    for batch in batches:
        done = []
        for k, position, role, text in zip(*(batch.column(c).to_pylist() for c in ("key", "position", "role", "text"))):
            if position == 0:
                if state is not None:
                    done.append((key, state.hexdigest()))
                key, state = k, sha256()
            state.update(f"{chr(10) if position else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        yield _pairs(done)
    if state is not None:
        yield _pairs([(key, state.hexdigest())])


def _pairs(done: Iterable[tuple[str, str]]) -> pa.RecordBatch:
    keys, values = zip(*done) if done else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(values, pa.string())], names=["key", "repaired_sha256"])


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` ``(conv, turn, role, text, times)``: ``conv_id``, ``gaps``, the counts of faults,
    ``cost``, ``audit`` and ``repaired_sha256``.

    Rows go by turn, nulls first; rows of one turn by role, the first 64 characters of the text and a digest of all.
    ``times`` says how often a row stands there; with 0 it only names its conversation. The repaired roles are an optional
    system row and pairs of user and assistant rows; roles count by their initial. A null conversation is one of its own. An empty
    table gives no rows. Very long conversations are cut into pieces; only the digest of a conversation, which is sequential,
    reads its rows in one task, as a stream.
    """
    found = store(plans(rows), "plans")
    digests = repaired_rows(rows, found).mapInArrow(_digests, "key string, repaired_sha256 string")
    # The key starts with a mark before the id; a null id is a dash.
    kind = rows.schema["conv"].dataType
    conv = F.when(F.col("key") != "-", F.substring("key", 2, 1 << 30)).cast(kind)
    empty = sha256().hexdigest()
    return found.join(digests, "key", "left").select(
        conv.alias("conv_id"), "gaps", *COUNTS[:4], "cost", "audit", F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))

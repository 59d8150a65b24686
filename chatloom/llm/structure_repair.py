"""12. Conversation structure repair by Four-Russians block tables.

A conversation is repaired by edits of its rows until the initials of its roles read ``(s?(ua)+)?``: Keep (0), Rerole to
user or assistant (2), Delete (3, required for blank and duplicate rows), Insert an empty user or assistant row (2); a
truncated row that stays costs 1 more. The cheapest edits are wanted, and of these the string of initials that is least
in ASCII.

What the rows so far leave to the rest is a vector of four costs, one for each state of that pattern. From the
cheapest state every continuation of any other can be had for 5 more, so entries beyond that are dead and only a few
vectors remain once their minimum is taken out. For each of them and each block of ``BLOCK`` row symbols a table says
the next vector and what is added to the cost; a conversation is read block by block. For the edits, the blocks are
expanded from the last to the first: all states on some cheapest path are marked, not one of them, so a walk from the
front may take the least letter at every step.

Spark reduces the rows to counted symbols per (conversation, turn, role, text digest), finds the first turn of each
text, and sorts the symbols; a task streams them and holds one conversation's symbols and edits, a byte a row. Texts
are shuffled once, sorted behind the edits of their conversation, and streamed: a row of the result has one digest
over all its texts, so their order is one task's work, but nothing of a conversation's texts is kept.

Cases: null role and text are one space; a null turn comes first and is one space in the damage key, as is a null
conversation id, which is a conversation of its own. Rows of one turn are ordered by role, then by text digest. A role
counts by its first character. Repeated rows are duplicates, as is every later row of equal role and text. Very long
texts stay whole. Conversations of which all rows are dropped have zeros, an empty audit and the digest of ''. An
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from chatloom.llm.registry import table
from chatloom.session import ship_package

BLOCK = 4
DEAD = 99
#: Memoised block expansions of a worker.
CACHED = 200_000
REROLE, DELETE, INSERT, TRUNCATED, SLACK = 2, 3, 2, 1, 5
#: States: nothing yet, after s, after u, after a. Accepting: the first and the last.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
ACCEPTING = (START, AFTER_A)
#: The state that a row of u or a leads to from each state, if it is legal there.
EXPECTED = {START: AFTER_U, AFTER_S: AFTER_U, AFTER_U: AFTER_A, AFTER_A: AFTER_U}
#: Row symbols: twice the place of its initial (3: another), 1 more if truncated; then a row to delete, and no row.
INITIALS = "sua"
GONE, PAD = 8, 9
SYMBOLS = 10


def _moves(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits of a row, least letter first."""
    if symbol == PAD:
        return [("", 0, state)]
    out = [("D", DELETE, state)]
    if symbol != GONE:
        initial, more = divmod(symbol, 2)
        if initial == 0 and state == START:
            out.append(("K", more * TRUNCATED, AFTER_S))
        if initial in (1, 2) and EXPECTED[state] == initial + 1:
            out.append(("K", more * TRUNCATED, EXPECTED[state]))
        out.append(("R", REROLE + more * TRUNCATED, EXPECTED[state]))
    return out


def _closed(costs: list[int]) -> list[int]:
    """With all inserts that could follow."""
    for _ in range(2):
        for state, to in EXPECTED.items():
            costs[to] = min(costs[to], costs[state] + INSERT)
    return costs


def _normal(costs: list[int]) -> tuple[tuple[int, ...], int]:
    least = min(costs)
    return tuple(c - least if c - least <= SLACK else DEAD for c in costs), least


class BlockTables:
    """Transitions of normalised cost vectors, by symbol and by block."""

    def __init__(self) -> None:
        first, _ = _normal(_closed([0, DEAD, DEAD, DEAD]))
        self.vectors, place, steps = [first], {first: 0}, []
        for vector in self.vectors:  # grows as vectors are met
            row = []
            for symbol in range(SYMBOLS):
                costs = [DEAD] * 4
                for state, cost in enumerate(vector):
                    for _, more, to in _moves(symbol, state):
                        costs[to] = min(costs[to], cost + more)
                then, least = _normal(_closed(costs))
                if then not in place:
                    place[then] = len(self.vectors)
                    self.vectors.append(then)
                row.append((place[then], least))
            steps.append(row)
        told = np.array(steps, np.int32)
        self.step, self.step_cost = told[:, :, 0].tolist(), told[:, :, 1].tolist()
        then, cost = told[:, :, 0], told[:, :, 1]
        for _ in range(BLOCK - 1):  # blocks are numbers to the base SYMBOLS, first symbol first
            then, cost = told[then, :, 0].reshape(len(told), -1), (cost[:, :, None] + told[then, :, 1]).reshape(len(told), -1)
        self.then, self.cost = then, cost
        self.marked: dict[tuple[int, int, int], tuple[list[int], list[int]]] = {}
        self.walked: dict[tuple[int, int, int, int], tuple[str, int]] = {}

    def _symbols(self, block: int) -> list[int]:
        return [block // SYMBOLS**i % SYMBOLS for i in range(BLOCK - 1, -1, -1)]

    def _mark(self, vector: int, block: int, last: int) -> tuple[list[int], list[int]]:
        """Vector and marked states (as bits) before each symbol and at the end, given the marked ones at the end."""
        key = vector, block, last
        if key in self.marked:
            return self.marked[key]
        symbols = self._symbols(block)
        vectors = [vector]
        for symbol in symbols:
            vectors.append(self.step[vectors[-1]][symbol])
        masks = [last]
        for i in range(BLOCK, 0, -1):
            masks.append(self._inserting(vectors[i - 1], sum(
                1 << state for state in range(4) if any(self._leads(vectors, i - 1, symbols[i - 1], state, move, masks[-1]) for move in _moves(symbols[i - 1], state)))))
        self.marked[key] = found = vectors, masks[::-1]
        return found

    def _leads(self, vectors: list[int], i: int, symbol: int, state: int, move: tuple[str, int, int], mask: int) -> bool:
        _, more, to = move
        cost, then = self.vectors[vectors[i]][state], self.vectors[vectors[i + 1]][to]
        return cost != DEAD and then != DEAD and mask >> to & 1 == 1 and then + self.step_cost[vectors[i]][symbol] == cost + more

    def _inserting(self, vector: int, mask: int) -> int:
        """With the states from which an insert leads to a marked one at its cost."""
        costs = self.vectors[vector]
        for _ in range(2):
            for state, to in EXPECTED.items():
                if mask >> to & 1 and costs[state] != DEAD and costs[to] == costs[state] + INSERT:
                    mask |= 1 << state
        return mask

    def _walk(self, vector: int, block: int, last: int, state: int) -> tuple[str, int]:
        """The least letters through a block from a marked state, and the state they lead to."""
        key = vector, block, last, state
        if key in self.walked:
            return self.walked[key]
        vectors, masks = self._mark(vector, block, last)
        letters, symbols, i = "", self._symbols(block), 0
        while i < BLOCK:
            ways = [(m[0], i + 1, m[2]) for m in _moves(symbols[i], state) if self._leads(vectors, i, symbols[i], state, m, masks[i + 1])]
            costs, to = self.vectors[vectors[i]], EXPECTED[state]
            if masks[i] >> to & 1 and costs[to] == costs[state] + INSERT:
                ways.append(("I", i, to))
            # a missing row has no letter: what is inserted there comes first
            letter, i, state = min(ways, key=lambda way: way[0] or "Z")
            letters += letter
        self.walked[key] = letters, state
        return letters, state

    def edits(self, symbols: np.ndarray) -> tuple[int, str]:
        """Cost and initials of the cheapest edits of a conversation."""
        if len(self.marked) + len(self.walked) > CACHED:
            self.marked.clear()
            self.walked.clear()
        padded = np.full((len(symbols) // BLOCK + 1) * BLOCK, PAD, np.int64)
        padded[:len(symbols)] = symbols
        blocks = (padded.reshape(-1, BLOCK) @ SYMBOLS ** np.arange(BLOCK - 1, -1, -1)).tolist()
        vector, cost = 0, 0
        border = []
        for block in blocks:
            border.append(vector)
            cost += int(self.cost[vector, block])
            vector = int(self.then[vector, block])
        costs = self.vectors[vector]
        least = min(costs[s] for s in ACCEPTING)
        mask = sum(1 << s for s in ACCEPTING if costs[s] == least)
        lasts = []
        for vector, block in zip(border[::-1], blocks[::-1], strict=True):
            lasts.append(mask)
            mask = self._mark(vector, block, mask)[1][0]
        state, out = START, []
        for vector, block, last in zip(border, blocks, lasts[::-1], strict=True):
            letters, state = self._walk(vector, block, last, state)
            out.append(letters)
        return cost + least, "".join(out)


@lru_cache(maxsize=1)
def tables() -> BlockTables:
    """One per worker process."""
    return BlockTables()


class Replay:
    """Applies the initials of edits to rows as they come."""

    def __init__(self, edits: str) -> None:
        self.edits, self.at, self.expected = edits, 0, "user"

    def _out(self, letter: str, role: str, text: str) -> tuple[str, str, str]:
        if role[:1] != "s":
            self.expected = "assistant" if role[:1] == "u" else "user"
        return letter, role, text

    def inserts(self) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of the rows inserted here."""
        while self.edits[self.at:self.at + 1] == "I":
            self.at += 1
            yield self._out("I", self.expected, "")

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of the rows inserted before a row, and of the row unless it is deleted."""
        yield from self.inserts()
        letter = self.edits[self.at]
        self.at += 1
        if letter != "D":
            yield self._out(letter, self.expected if letter == "R" else role, text)


def damage(rows: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, copies)``: rows with the faults that a checksum of their place gives them."""
    told = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fault = F.crc32(F.concat(told[0], F.lit(":"), told[1])) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), fault.alias("fault")).select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("fault") == 0, 0).when(F.col("fault") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _digest() -> Column:
    return F.unhex(F.sha2("text", 256))


def _symbols(rows: DataFrame) -> DataFrame:
    """A row per conversation, turn, role and text: copies, and whether the text is blank, truncated or was seen before."""
    text = F.col("text")
    counted = (
        rows.select("conv_id", "turn", "role", "copies", _digest().alias("digest"), (~text.rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
                    (~text.rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("truncated"))
        .groupBy("conv_id", "turn", "role", "digest").agg(F.sum("copies").alias("copies"), F.max("blank").alias("blank"), F.max("truncated").alias("truncated"))
    )
    met = counted.filter("copies > 0").groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d")).agg(
        F.min("turn").alias("first"), F.max(F.col("turn").isNull()).alias("before_all"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    seen = F.when(F.col("before_all"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("first"))
    return counted.join(met, same, "left").select("conv_id", "turn", "role", "digest", "copies", "blank", "truncated", F.coalesce(seen, F.lit(False)).alias("seen"))


def _ordered(rows: DataFrame, *more: str) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *more, F.col("turn").asc_nulls_first(), "role", "digest")


class _Conversation:
    def __init__(self, conv_id: object) -> None:
        self.conv_id, self.parts = conv_id, []
        self.low = self.high = self.turn = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.initial: str | None = None

    def add(self, turn: int | None, role: str, copies: int, blank: bool, truncated: bool, seen: bool) -> None:
        if not copies:
            return
        if turn is not None and turn != self.turn:
            self.low = turn if self.low is None else self.low
            self.high = self.turn = turn
            self.turns += 1
        initial = role[:1]
        pair = (self.initial or "") + initial
        if self.initial is not None and pair not in ("su", "ua", "au"):
            self.illegal += 1
        self.illegal += copies - 1
        self.initial = initial
        gone = blank or seen
        place = INITIALS.find(initial) if initial else -1
        symbol = GONE if gone else 2 * (place if place >= 0 else 3) + truncated
        self.parts.append(np.full(copies, GONE, np.int8))
        self.parts[-1][0] = symbol
        if blank:
            self.blank += copies
        else:
            self.duplicate += copies - (not seen)
            self.truncated += truncated and not seen

    def result(self) -> tuple:
        cost, audit = tables().edits(np.concatenate(self.parts) if self.parts else np.zeros(0, np.int8))
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _arrow(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", *COUNTS, "audit"]
    now, kinds = None, None
    for batch in batches:
        kinds = kinds or [batch.schema.field(0).type, *[pa.int64()] * len(COUNTS), pa.string()]
        done = []
        for conv_id, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    done.append(now.result())
                now = _Conversation(conv_id)
            now.add(*row)
        if done:
            yield _arrow(done, names, kinds)
    if now is not None:
        yield _arrow([now.result()], names, kinds)


def audits(rows: DataFrame) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit)`` of rows with their number of ``copies``."""
    ship_package(rows.sparkSession)
    symbols = _ordered(_symbols(rows)).select("conv_id", "turn", "role", "copies", "blank", "truncated", "seen")
    kind = rows.schema["conv_id"].dataType.simpleString()
    return symbols.mapInArrow(_audit, f"conv_id {kind}, {', '.join(f'{c} long' for c in COUNTS)}, audit string")


def _id_types(rows: DataFrame) -> tuple[str, pa.DataType]:
    kind = rows.schema["conv_id"].dataType
    return kind.simpleString(), to_arrow_type(kind)


def _behind_audits(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Texts in order, each conversation's after its audit."""
    texts = rows.filter("copies > 0").select("conv_id", "turn", "role", "text", "copies", _digest().alias("digest"), F.lit(1).alias("kind"))
    return _ordered(texts.unionByName(found.withColumn("kind", F.lit(0)), allowMissingColumns=True), "kind")


def _replayed(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[dict, tuple[str, str, str] | None]]]:
    """Per batch: (audit row, None) at each conversation's start, then (audit row, repaired row) for its repaired rows."""
    head, replay = None, Replay("")
    for batch in batches:
        names, out = batch.schema.names, []
        for values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            row = dict(zip(names, values, strict=True))
            if row["kind"] == 0:
                out += [(head, told) for told in replay.inserts()]
                head, replay = row, Replay(row["audit"])
                out.append((head, None))
            else:
                for _ in range(row["copies"]):
                    out += [(head, told) for told in replay.row(row["role"], row["text"])]
        yield out
    yield [(head, told) for told in replay.inserts()]


def repair(rows: DataFrame) -> DataFrame:
    """``(conv_id, position, edit, role, text)``: the rows of each repaired conversation, from position 0."""
    kind, arrow = _id_types(rows)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        position = 0
        for told in _replayed(batches):
            out = []
            for head, row in told:
                if row is None:
                    position = 0
                else:
                    out.append((head["conv_id"], position, *row))
                    position += 1
            if out:
                yield _arrow(out, ["conv_id", "position", "edit", "role", "text"], [arrow, pa.int64(), pa.string(), pa.string(), pa.string()])

    return _behind_audits(rows, audits(rows)).mapInArrow(work, f"conv_id {kind}, position long, edit string, role string, text string")


def reports(rows: DataFrame) -> DataFrame:
    """``audits`` with the digest of each repaired conversation's rows."""
    kind, arrow = _id_types(rows)
    names = ["conv_id", *COUNTS, "audit", "repaired_sha256"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, joint = None, hashlib.sha256(), ""
        kinds = [arrow, *[pa.int64()] * len(COUNTS), pa.string(), pa.string()]

        def result() -> tuple:
            return (now["conv_id"], *(now[c] for c in COUNTS), now["audit"], digest.hexdigest())

        for told in _replayed(batches):
            out = []
            for head, row in told:
                if row is None:
                    if now is not None:
                        out.append(result())
                    now, digest, joint = head, hashlib.sha256(), ""
                else:
                    digest.update(f"{joint}{row[1]}:{row[2]}".encode())
                    joint = "\n"
            if out:
                yield _arrow(out, names, kinds)
        if now is not None:
            yield _arrow([result()], names, kinds)

    return _behind_audits(rows, audits(rows)).mapInArrow(work, f"conv_id {kind}, {', '.join(f'{c} long' for c in COUNTS)}, audit string, repaired_sha256 string")


QUERY = "op12_structure_repair"
#: DuckDB has no crc32, which deals the faults; the tests compare with a plain search.
ORACLE_SQL = None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports(damage(table(spark, sf_dir, "conversations")))

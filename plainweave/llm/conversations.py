"""Repair of the turn structure of conversations by cheapest edits.

A conversation's rows, in order of turn, are kept, given another role, deleted
or preceded by inserted turns, until the roles are an optional system turn and
then user and assistant by turns. A dynamic programme over rows and four
states (nothing yet, after system, after user, after assistant) finds the
cheapest edits; of equally cheap ones the audit, the string of their initials,
that comes first in ASCII order.

Prefixes of audits are linked nodes that share their beginnings, with their
ancestors at distances of powers of two and a rolling hash. Two audits of equal
cost are compared by searching their longest common prefix along those
ancestors; equal hashes of different nodes are verified label by label. A
label is the edits of one row, insertions first, and ends with the row's own
edit, so that no label is the beginning of another.

Rows are sorted in ranges that cut through conversations. A task edits the
conversations it holds whole; of others, and of very long ones, it returns
pieces: the cheapest edits from each state to each. Pieces are narrow and are
put together per conversation. Texts take no part in that: they move twice,
once to meet their copies and once to be written out in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plainweave.operators.staging import stage

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
LETTER = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
NAME = {USER: "user", ASSISTANT: "assistant"}
DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1
# insertions that lead from a state to another, at no more than needed
INSERTED = {
    START: ((START, ""), (USER, "I"), (ASSISTANT, "II")), SYSTEM: ((SYSTEM, ""), (USER, "I"), (ASSISTANT, "II")),
    USER: ((USER, ""), (ASSISTANT, "I")), ASSISTANT: ((ASSISTANT, ""), (USER, "I")),
}
FOLLOWS = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
PIECE_ROWS = 8192  # of a piece; also what a task holds of one conversation
RANGE_ROWS = 1_000_000
SPACE = " \t\n\v\f\r"
HEAD = 64  # characters by which rows of one turn and role are ordered, before digests
PRIME, BASE = (1 << 61) - 1, 1_000_003
ENDS = ((START, ""), (ASSISTANT, ""), (USER, "I"), (SYSTEM, "II"))


# --- linked audits --------------------------------------------------------------


class Node:
    """A prefix of an audit: its last label, the node before it, ancestors at
    distances 1, 2, 4, ... and the rolling hash of the whole prefix."""

    __slots__ = ("label", "ancestors", "hash")

    def __init__(self, before: "Node | None", label: str):
        self.label = label
        self.ancestors: list[Node] = []
        if before is None:
            self.hash = 0
            return
        up, k = before, 0
        while True:
            self.ancestors.append(up)
            if k >= len(up.ancestors):
                break
            up, k = up.ancestors[k], k + 1
        code = before.hash
        for byte in label.encode():
            code = (code * BASE + byte) % PRIME
        self.hash = code

    def text(self) -> str:
        parts, node = [], self
        while node.ancestors:
            parts.append(node.label)
            node = node.ancestors[0]
        return "".join(reversed(parts))


def same(a: Node, b: Node) -> bool:
    """Whether two prefixes of as many rows are equal; equal hashes are verified."""
    if a is b:
        return True
    if a.hash != b.hash:
        return False
    while a is not b:
        if a.label != b.label:
            return False
        if not a.ancestors:
            return True
        a, b = a.ancestors[0], b.ancestors[0]
    return True


def before(a: Node, b: Node) -> bool:
    """Whether audit `a` comes before `b` of as many rows: their labels after
    the longest common prefix decide, which is found by leaps."""
    if same(a, b):
        return False
    for k in range(len(a.ancestors) - 1, -1, -1):
        if k < len(a.ancestors) and not same(a.ancestors[k], b.ancestors[k]):
            a, b = a.ancestors[k], b.ancestors[k]
    return a.label < b.label


Front = dict[int, tuple[int, Node]]  # the cheapest audit that ends in each state


def offer(front: Front, state: int, cost: int, parent: Node, label: str) -> None:
    known = front.get(state)
    if known is None or cost < known[0]:
        front[state] = (cost, Node(parent, label))
    elif cost == known[0]:
        node = Node(parent, label)
        if before(node, known[1]):
            front[state] = (cost, node)


def edited(front: Front, initial: str, copies: int, blank: bool, earlier: bool, truncated: bool) -> Front:
    """Fronts after one more row that stands `copies` times: copies after the
    first, blank rows and those seen earlier can only be deleted."""
    out: Front = {}
    rest = "D" * (copies - 1)
    paid = DELETE * (copies - 1)
    for state, (cost, node) in front.items():
        offer(out, state, cost + DELETE + paid, node, "D" + rest)
        if blank or earlier:
            continue
        late = TRUNCATED if truncated else 0
        for at, inserted in INSERTED[state]:
            here = cost + INSERT * len(inserted) + late + paid
            kept = FOLLOWS[at].get(initial)
            if kept is not None:
                offer(out, kept, here, node, inserted + "K" + rest)
            given = ASSISTANT if at == USER else USER
            offer(out, given, here + REROLE, node, inserted + "R" + rest)
    return out


def ended(front: Front) -> tuple[int, Node, str]:
    """Cheapest cost, audit and closing insertions."""
    best = None
    for state, closing in ENDS:
        if state in front:
            cost, node = front[state][0] + INSERT * len(closing), front[state][1]
            if best is None or cost < best[0] or cost == best[0] and before(node, best[1]):
                best = (cost, node, closing)
    return best


# --- pieces of conversations ------------------------------------------------------


class Piece:
    """What a run of rows of one conversation comes to."""

    def __init__(self, states):
        self.fronts = {s: {s: (0, Node(None, ""))} for s in states}
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_turn = self.last_turn = None
        self.first_role = self.last_role = None

    def add(self, turn, initial: str, copies: int, blank: bool, earlier: bool, truncated: bool) -> None:
        if turn is not None and (self.last_turn is None or turn != self.last_turn):
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        if self.last_role is not None and self.last_role + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.illegal += copies - 1  # a role is never followed by itself
        self.first_role = initial if self.first_role is None else self.first_role
        self.last_role = initial
        if blank:
            self.blank += copies
        else:
            self.duplicate += copies - 1 + earlier
            self.truncated += truncated and not earlier
        self.rows += 1
        self.fronts = {s: edited(f, initial, copies, blank, earlier, truncated) for s, f in self.fronts.items()}

    def told(self, key, part: int, number: int) -> dict:
        paths = [
            {"enter": s, "leave": t, "cost": cost, "audit": node.text()}
            for s, front in self.fronts.items() for t, (cost, node) in front.items()
        ]
        return {
            "conv": key, "part": part, "number": number, "gaps": None, "blank": self.blank, "duplicate": self.duplicate,
            "truncated": self.truncated, "illegal": self.illegal, "turns": self.turns, "first_turn": self.first_turn,
            "last_turn": self.last_turn, "first_role": self.first_role, "last_role": self.last_role, "cost": None,
            "audit": None, "paths": paths,
        }

    def finished(self, key) -> dict:
        cost, node, closing = ended(self.fronts[START])
        return self.told(key, 0, 0) | {
            "gaps": gaps(self.first_turn, self.last_turn, self.turns), "cost": cost, "audit": node.text() + closing, "paths": None,
        }


def gaps(first, last, turns: int) -> int:
    return last - first + 1 - turns if turns else 0


PATH = T.ArrayType(T.StructType([
    T.StructField("enter", T.IntegerType()), T.StructField("leave", T.IntegerType()), T.StructField("cost", T.LongType()),
    T.StructField("audit", T.StringType()),
]))
STATISTICS = ["gaps", "blank", "duplicate", "truncated", "illegal"]


def _piece_schema(conv: T.DataType) -> T.StructType:
    longs = ["part", "number", *STATISTICS, "turns", "first_turn", "last_turn"]
    fields = [T.StructField("conv", conv), *(T.StructField(c, T.LongType()) for c in longs)]
    fields += [T.StructField(c, T.StringType()) for c in ("first_role", "last_role")]
    return T.StructType([*fields, T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType()), T.StructField("paths", PATH)])


def _batches(made: Iterator[dict], schema: pa.Schema, rows: int, size: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Batches of rows, cut where their audits or texts grow large."""
    kept, held = [], 0
    for row in made:
        kept.append(row)
        held += sum(len(v) for v in row.values() if isinstance(v, str)) + sum(len(p["audit"]) for p in row.get("paths") or ())
        if len(kept) >= rows or held >= size:
            yield pa.RecordBatch.from_pylist(kept, schema)
            kept, held = [], 0
    if kept:
        yield pa.RecordBatch.from_pylist(kept, schema)


def _column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(name).to_pylist()


def _pieces(schema: T.StructType, piece_rows: int):
    """Over sorted rows: finished conversations, and pieces of those that the
    range may have cut or that are long."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def made(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        key, piece, number, alone = None, None, 0, False
        for batch in batches:
            names = ("conv", "turn", "initial", "copies", "blank", "earlier", "truncated")
            for conv, turn, *row in zip(*(_column(batch, c) for c in names)):
                if piece is not None and conv != key:
                    yield piece.finished(key) if alone else piece.told(key, part, number)
                    # a conversation after another one begins here
                    key, piece, number, alone = conv, Piece([START]), 0, True
                elif piece is None:  # it may go on from the range before
                    key, piece = conv, Piece(STATES)
                elif piece.rows >= piece_rows:
                    yield piece.told(key, part, number)
                    piece, number, alone = Piece(STATES), number + 1, False
                piece.add(turn, *row)
        if piece is not None:  # it may go on in the next range
            yield piece.told(key, part, number)

    return lambda batches: _batches(made(batches), arrow, 2048)


def _joined(schema: T.StructType):
    """Over pieces in order: each conversation put together from its pieces."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def started(row):
        return row | {"front": {START: (0, Node(None, ""))}, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "turns": 0,
                      "first_turn": None, "last_turn": None, "first_role": None, "last_role": None, "paths": None}

    def add(whole, row):
        front: Front = {}
        for path in row["paths"]:
            if path["enter"] in whole["front"]:
                cost, node = whole["front"][path["enter"]]
                offer(front, path["leave"], cost + path["cost"], node, path["audit"])
        whole["front"] = front
        for c in ("blank", "duplicate", "truncated", "illegal", "turns"):
            whole[c] += row[c]
        if whole["last_role"] is not None:
            whole["illegal"] += whole["last_role"] + row["first_role"] not in ("su", "ua", "au")
        if row["turns"]:
            whole["turns"] -= whole["last_turn"] is not None and whole["last_turn"] == row["first_turn"]
            whole["first_turn"] = row["first_turn"] if whole["first_turn"] is None else whole["first_turn"]
            whole["last_turn"] = row["last_turn"]
        whole["first_role"] = row["first_role"] if whole["first_role"] is None else whole["first_role"]
        whole["last_role"] = row["last_role"]

    def finished(whole):
        cost, node, closing = ended(whole.pop("front"))
        counted = gaps(whole["first_turn"], whole["last_turn"], whole["turns"])
        return whole | {"gaps": counted, "cost": cost, "audit": node.text() + closing}

    def made(batches):
        whole = None
        for batch in batches:
            for at in range(batch.num_rows):  # one at a time: audits may be long
                (row,) = batch.slice(at, 1).to_pylist()
                if whole is None or row["conv"] != whole["conv"]:
                    if whole is not None:
                        yield finished(whole)
                    whole = started(row)
                add(whole, row)
        if whole is not None:
            yield finished(whole)

    return lambda batches: _batches(made(batches), arrow, 2048)


# --- writing the repaired conversation --------------------------------------------


class Scribe:
    """Reads an audit along the rows of its conversation."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            self.state = ASSISTANT if self.state == USER else USER
            yield NAME[self.state], "", "I"

    def row(self, role: str, text: str, copies: int) -> Iterator[tuple[str, str, str]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += copies
        if edit == "K":
            self.state = LETTER[role[0]]
            yield role, text, "K"
        elif edit == "R":
            self.state = ASSISTANT if self.state == USER else USER
            yield NAME[self.state], text, "R"


def _read(batches, with_turns: bool) -> Iterator[dict]:
    """Over a conversation's audit, first, and then its rows."""
    key, scribe, digest, place = None, None, None, 0

    def rows(made):
        nonlocal place
        for role, text, edit in made:
            digest.update((("\n" if place else "") + role + ":" + text).encode())
            if with_turns:
                yield {"conv": key, "place": place, "role": role, "text": text, "edit": edit}
            place += 1

    def closed():
        yield from rows(scribe.inserted())
        if not with_turns:
            yield {"conv": key, "repaired_sha256": digest.hexdigest()}

    for batch in batches:
        for conv, audit, role, text, copies in zip(*(_column(batch, c) for c in ("conv", "audit", "role", "text", "copies"))):
            if audit is not None:
                if scribe is not None:
                    yield from closed()
                key, scribe, digest, place = conv, Scribe(audit), hashlib.sha256(), 0
            else:
                yield from rows(scribe.row(role, text, copies))
    if scribe is not None:
        yield from closed()


def _order() -> list:
    return [F.col("turn").asc_nulls_first(), "role", "head", "g", "h"]


class Repair:
    """`audits`: a row per conversation of `conversations` with gaps, blank,
    duplicate, truncated, illegal, cost and audit. `turns()`: the repaired turns
    (place, role, text, edit). `digests()`: the digest of their `role:text`
    lines.

    `known` may list conversations that have lost all rows: they have zeros and
    an empty audit. Null conversations are one conversation; null roles and
    texts are one space; null turns come first. Rows of one turn stand in order
    of role, text (64 characters, then a digest); equal rows stand together, and
    all but the first are duplicates. A role without a character is never kept.
    A conversation may have any number of rows; its audit is one string. Texts
    are read whole, however long. An empty table gives an empty result; other
    columns play no part, whatever their names.
    """

    def __init__(
        self, conversations: DataFrame, known: DataFrame | None = None, conv_col: str = "conv_id", turn_col: str = "turn",
        role_col: str = "role", text_col: str = "text", piece_rows: int = PIECE_ROWS, range_rows: int = RANGE_ROWS,
    ):
        self.name = conv_col
        one_space = lambda c: F.coalesce(F.col(c), F.lit(" "))
        given = conversations.select(
            F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), one_space(role_col).alias("role"),
            one_space(text_col).alias("text"),
        )
        once = given.groupBy("conv", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
        seen = [F.xxhash64("text").alias("g"), F.xxhash64(F.lit("turn"), "text").alias("h")]
        self.rows = stage(once.select("*", F.substring("text", 1, HEAD).alias("head"), *seen))
        self.conv_type = self.rows.schema["conv"].dataType
        listed = (known.select(F.col(conv_col).alias("conv")) if known is not None else self.rows.select("conv")).distinct()
        solved = self._solved(piece_rows, range_rows)
        facts = [c for c in (*STATISTICS, "cost", "audit")]
        joined = listed.join(solved.withColumnRenamed("conv", "own"), F.col("conv").eqNullSafe(F.col("own")), "left")
        zero = {c: F.lit("" if c == "audit" else 0) for c in facts}
        self.audits = stage(joined.select("conv", *[F.coalesce(F.col(c), zero[c]).alias(c) for c in facts]))

    def _solved(self, piece_rows: int, range_rows: int) -> DataFrame:
        spark = self.rows.sparkSession
        last = F.substring(F.rtrim("text", F.lit(SPACE)), -1, 1)
        narrow = self.rows.select(
            "conv", "turn", "role", "head", "g", "h", "copies", F.substring("role", 1, 1).alias("initial"), last.alias("last")
        )
        blank = F.col("last") == ""
        narrow = narrow.select(
            *[c for c in narrow.columns if c != "last"], blank.alias("blank"),
            (~blank & ~F.col("last").isin(".", "!", "?")).alias("truncated"),
        )
        place = F.struct(F.col("turn").isNotNull(), "turn")
        texts = narrow.groupBy("conv", "role", "g", "h").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
        again = stage(texts.where("n > 1").select(F.col("conv").alias("c"), *[F.col(x).alias(f"{x}_") for x in ("role", "g", "h")], "first"))
        equal = F.col("conv").eqNullSafe(F.col("c"))
        for x in ("role", "g", "h"):
            equal = equal & (F.col(x) == F.col(f"{x}_"))
        earlier = F.coalesce(F.col("first") < place, F.lit(False)).alias("earlier")
        flagged = stage(narrow.join(again, equal, "left").select(*narrow.columns, earlier))
        setting = int(spark.conf.get("spark.sql.shuffle.partitions"))
        wanted = -(-flagged.count() // range_rows)
        order = [F.col("conv").asc_nulls_first(), *_order()]
        ranged = flagged.repartitionByRange(*([wanted] if wanted > setting else []), *order).sortWithinPartitions(*order)
        schema = _piece_schema(self.conv_type)
        pieces = stage(ranged.mapInArrow(_pieces(schema, piece_rows), schema))
        cut = pieces.where(F.col("paths").isNotNull())
        together = cut.repartition("conv").sortWithinPartitions("conv", "part", "number").mapInArrow(_joined(schema), schema)
        return pieces.where(F.col("paths").isNull()).unionByName(together).select("conv", *STATISTICS, "cost", "audit")

    def _written(self, with_turns: bool) -> DataFrame:
        from pyspark.sql.pandas.types import to_arrow_schema

        none = lambda kind: F.lit(None).cast(kind)
        heads = self.audits.select(
            "conv", F.lit(0).alias("kind"), "audit", none("long").alias("turn"), none("string").alias("role"), none("string").alias("text"),
            none("long").alias("copies"), none("string").alias("head"), none("long").alias("g"), none("long").alias("h"),
        )
        bodies = self.rows.select(
            "conv", F.lit(1).alias("kind"), none("string").alias("audit"), "turn", "role", "text", "copies", "head", "g", "h"
        )
        sorted_ = heads.unionByName(bodies).repartition("conv").sortWithinPartitions("conv", "kind", *_order())
        fields = [("place", T.LongType()), ("role", T.StringType()), ("text", T.StringType()), ("edit", T.StringType())]
        fields = fields if with_turns else [("repaired_sha256", T.StringType())]
        schema = T.StructType([T.StructField("conv", self.conv_type), *(T.StructField(c, k) for c, k in fields)])
        arrow = to_arrow_schema(schema)
        read = sorted_.select("conv", "audit", "role", "text", "copies")
        return read.mapInArrow(lambda batches: _batches(_read(batches, with_turns), arrow, 2048), schema)

    def turns(self) -> DataFrame:
        """The repaired turns of every conversation."""
        return self._written(True).withColumnRenamed("conv", self.name)

    def digests(self) -> DataFrame:
        """The audits with repaired_sha256, of the repaired turns as `role:text`
        joined by newlines. A digest is made in order, so one task reads the
        texts of a conversation, but it holds a batch of them only."""
        made = self._written(False).withColumnRenamed("conv", "own")
        joined = self.audits.join(made, F.col("conv").eqNullSafe(F.col("own")))
        return joined.select(F.col("conv").alias(self.name), *STATISTICS, "cost", "audit", "repaired_sha256")


def damage(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with faults by a checksum of conversation
    and turn: dropped, emptied, without full stops, repeated, or given to the
    user. Nulls are one space."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), fault.alias("fault")).where("fault != 0")
    is_ = lambda k: F.col("fault") == k
    rows = rows.select(
        "conv_id", "turn", F.when(is_(4), F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(is_(1), F.lit("")).when(is_(2), F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(is_(3), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return rows.drop("copy")

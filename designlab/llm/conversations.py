"""Conversation structure repair: the cheapest edits that give each conversation a well-formed order of roles.

Rows are repartitioned by conversation and sorted by turn within partitions, and ``mapInArrow`` reads the
sorted stream, carrying one conversation's state across Arrow batches.  The state is a dynamic programme over
four places in a conversation (nothing yet, after the system row, after a user row, after an assistant
row): for each the least cost to be there, and its place in the order of the edit strings that lead there, so
that ties need no strings.  Each row adds one backpointer byte per place.  At a conversation's end the
backpointers are followed back, and the edits are played forward over the rows.

A conversation that outgrows ``HELD_ROWS`` or ``HELD_BYTES`` is spilled: its rows and backpointers so far
become output rows (parts), so a task holds one part of it at most.  Parts lie in the shared folder; one pass
in descending order follows the backpointers, one in ascending order plays the edits.  Repeated rows of a
conversation are marked by Spark's window over the same partitions, whose buffers spill, so no set of texts
seen grows with a conversation.

Well-formed: no row, or role initials ``s?(ua)+``.  Edits of a row, by initial: (K)eep, (R)erole to user or
assistant, (D)elete, and before it or at the end (I)nsert an empty user or assistant row.

Defined cases: a null conv_id is a conversation of its own; null turns come first; null roles and texts are
one space; rows of equal turn go by role, then text; a role without a character has no initial; repeated
rows are duplicates (and so deleted); a conversation without rows has no edits; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_type

from designlab.llm.stored import stored

#: of one conversation, a task holds at most this much before it spills a part
HELD_ROWS = 1 << 15
HELD_BYTES = 8 << 20
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
SPACES = " \t\n\x0b\x0c\r"
SOUND, BLANK, DUPLICATE, CUT, GONE = range(5)

# places in a conversation
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: where an inserted or reroled row leads, and its role
NEXT = {NOTHING: (USER, "user"), SYSTEM: (USER, "user"), ASSISTANT: (USER, "user"), USER: (ASSISTANT, "assistant")}
#: inserts before the end, per place
TAIL = (0, 2, 1, 0)
LETTERS = "DKR"


def kept_to(place: int, initial: str) -> int | None:
    """Place after a kept row of this role initial, if it may stand there."""
    if initial == "s":
        return SYSTEM if place == NOTHING else None
    if initial == "u":
        return USER if place != USER else None
    return ASSISTANT if initial == "a" and place == USER else None


@functools.lru_cache(maxsize=None)
def step(places: tuple, initial: str, must_go: bool, cut: bool) -> tuple[tuple, int, bytes]:
    """Places after one row, the cost taken out of them, and a backpointer byte for each.

    ``places`` has (cost over the least, order of the edit string) or None per place.  The edit strings of
    two places after the same rows are never prefixes of each other (both end with a row's letter, and the
    string decides the place), so their order stays whatever follows.  Places that can no longer win are
    given up, so costs differ by the price of a few edits at most and there are few different arguments.
    """
    found: list = [None] * 4
    for start, held in enumerate(places):
        if held is None:
            continue
        cost, order = held
        place = start
        for inserts in range(3):
            options = [("D", place, DELETE)]
            if not must_go:
                extra = TRUNCATED if cut else 0
                options.append(("R", NEXT[place][0], REROLE + extra))
                if (to := kept_to(place, initial)) is not None:
                    options.append(("K", to, KEEP + extra))
            for letter, to, price in options:
                rank = (cost + inserts * INSERT + price, order, "I" * inserts + letter)
                if found[to] is None or rank < found[to][0]:
                    found[to] = rank, start | inserts << 2 | LETTERS.index(letter) << 4
            place = NEXT[place][0]
    # an insert leads from USER to ASSISTANT, from where all that SYSTEM allows can follow as cheaply, and all
    # that NOTHING allows for the price of deleting a system row
    reached = min([found[ASSISTANT][0][0]] * bool(found[ASSISTANT]) + [found[USER][0][0] + INSERT] * bool(found[USER]),
                  default=None)
    for place, more in ((SYSTEM, 0), (NOTHING, DELETE)):
        if reached is not None and found[place] and found[place][0][0] > reached + more:
            found[place] = None
    least = min(f[0][0] for f in found if f)
    orders = sorted(f[0][1:] for f in found if f)
    after = tuple(f and (f[0][0] - least, orders.index(f[0][1:])) for f in found)
    return after, least, bytes(f[1] if f else 0 for f in found)


BEGIN = ((0, 0), None, None, None)


def finish(places: tuple) -> tuple[int, int]:
    """(cost over the least, place) of the cheapest end, ties by edit string."""
    cost, _, place = min((held[0] + TAIL[p] * INSERT, held[1], p) for p, held in enumerate(places) if held)
    return cost, place


def follow(back: bytes, place: int) -> tuple[int, bytes]:
    """(place before the first row, one byte per row: inserts before it and its letter) that lead to ``place``."""
    out = bytearray(len(back) // 4)
    for i in range(len(out) - 1, -1, -1):
        b = back[4 * i + place]
        out[i] = b >> 2
        place = b & 3
    return place, bytes(out)


def play(place: int, edits: bytes, roles: list[str], texts: list[str], tail: int) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of each edit; a deleted row's role and text are its own."""
    for edit, role, text in zip(edits, roles, texts, strict=True):
        for _ in range(edit & 3):
            place, new = NEXT[place]
            yield "I", new, ""
        letter = LETTERS[edit >> 2]
        if letter == "K":
            place = kept_to(place, role[:1])
        elif letter == "R":
            place, role = NEXT[place]
        yield letter, role, text
    for _ in range(tail):
        place, new = NEXT[place]
        yield "I", new, ""


class Digest:
    """Edit string and digest of the repaired rows of one conversation, taken in pieces."""

    def __init__(self):
        self.letters: list[str] = []
        self.sha = hashlib.sha256()
        self.some = False

    def add(self, edits: Iterator[tuple[str, str, str]]) -> None:
        out, letters = [], []
        for letter, role, text in edits:
            letters.append(letter)
            if letter != "D":
                out.append(f"{role}:{text}")
        self.letters.append("".join(letters))
        if out:
            self.sha.update((("\n" if self.some else "") + "\n".join(out)).encode("utf-8", "surrogatepass"))
            self.some = True

    def result(self) -> dict:
        return {"audit": "".join(self.letters), "repaired_sha256": self.sha.hexdigest()}


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
PARTS = [("part", pa.int64()), ("last", pa.bool_()), ("place", pa.int32()), ("edits", pa.binary()),
         ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))]
LEGAL = {"su", "ua", "au"}


class Conversation:
    """Counts, places and backpointers of the conversation at hand, and its rows since the last spill."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.places, self.cost, self.part = BEGIN, 0, 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.least = self.turn = self.before = None
        self._empty()

    def _empty(self) -> None:
        self.back, self.roles, self.texts, self.held = [], [], [], 0

    def add(self, turn, role: str, text: str, fault: int) -> None:
        initial = role[:1]
        if self.before is not None and self.before + initial not in LEGAL:
            self.illegal += 1
        self.before = initial
        if turn is not None and turn != self.turn:
            self.least = turn if self.least is None else self.least
            self.turn = turn
            self.turns += 1
        self.blank += fault == BLANK
        self.duplicate += fault == DUPLICATE
        self.truncated += fault == CUT
        self.places, cost, back = step(self.places, initial if initial in "sua" else "", fault in (BLANK, DUPLICATE),
                                       fault == CUT)
        self.cost += cost
        self.back.append(back)
        self.roles.append(role)
        self.texts.append(text)
        self.held += len(text) + len(role)

    def full(self, rows: int, size: int) -> bool:
        return len(self.back) >= rows or self.held >= size

    def spill(self, last: bool = False, place: int | None = None) -> dict:
        """The rows since the last spill as an output row; ``edits`` has their backpointers."""
        out = {"conv_id": self.conv_id, "part": self.part, "last": last, "place": place, "edits": b"".join(self.back),
               "roles": self.roles, "texts": self.texts}
        self.part += 1
        self._empty()
        return out

    def counts(self, cost: int) -> dict:
        gaps = 0 if self.least is None else self.turn - self.least + 1 - self.turns
        return {"gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated,
                "illegal": self.illegal, "cost": self.cost + cost}

    def end(self) -> dict:
        """The conversation's result, or its last part where others are spilled."""
        cost, place = finish(self.places)
        if self.part:
            return self.spill(True, place) | self.counts(cost)
        start, edits = follow(b"".join(self.back), place)
        return {"conv_id": self.conv_id, "place": place, "edits": edits, "roles": self.roles, "texts": self.texts,
                "start": start} | self.counts(cost)


def conversations(batches, held: tuple[int, int] = (HELD_ROWS, HELD_BYTES)) -> Iterator[dict]:
    """Ends and spilled parts of the conversations of a sorted stream of rows."""
    now = None
    for batch in batches:
        for conv_id, turn, role, text, fault in zip(*(batch.column(c).to_pylist() for c in ROW), strict=True):
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    yield now.end()
                now = Conversation(conv_id)
            if fault != GONE:
                now.add(turn, role, text, fault)
                if now.full(*held):
                    yield now.spill()
    if now is not None:
        yield now.end()


ROW = ("conv_id", "turn", "role", "text", "fault")


def sorted_rows(rows: DataFrame) -> DataFrame:
    """Rows with their first fault, by conversation, in order.  ``gone`` rows only name their conversation."""
    part = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                       F.coalesce("text", F.lit(" ")).alias("text"), "gone").repartition("conv_id")
    seen = Window.partitionBy("conv_id", "gone", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    fault = (F.when(F.col("gone"), GONE).when(F.length(bare) == 0, BLANK).when(F.col("copy") > 1, DUPLICATE)
             .when(~F.right(bare, F.lit(1)).isin(*".!?"), CUT).otherwise(SOUND))
    return (part.withColumn("copy", F.row_number().over(seen)).withColumn("fault", fault)
            .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text", "copy")
            .select("conv_id", "turn", F.when(~F.col("gone"), F.col("role")).alias("role"),
                    F.when(~F.col("gone"), F.col("text")).alias("text"), "fault"))


def _schema(conv_id: pa.DataType, fields) -> pa.Schema:
    return pa.schema([("conv_id", conv_id), *fields])


def _batches(rows: Iterator[dict], schema: pa.Schema, most: int = 1000) -> Iterator[pa.RecordBatch]:
    """Arrow batches of result rows; a spilled part closes its batch, so a batch holds one at most."""
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= most or row.get("part") is not None:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _summary(found: dict) -> dict:
    digest = Digest()
    digest.add(play(found["start"], found["edits"], found["roles"], found["texts"], TAIL[found["place"]]))
    return {k: found[k] for k in ("conv_id", *COUNTS)} | digest.result()


def _edits(found: dict) -> Iterator[dict]:
    for i, (edit, role, text) in enumerate(play(found["start"], found["edits"], found["roles"], found["texts"],
                                                TAIL[found["place"]])):
        yield {"conv_id": found["conv_id"], "position": i, "edit": edit, "role": role, "text": text}


SUMMARY = [(c, pa.int64()) for c in COUNTS] + [("audit", pa.string()), ("repaired_sha256", pa.string())]
EDITS = [("position", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]


def _decided(parts: DataFrame, schema: pa.Schema) -> DataFrame:
    """Spilled parts with ``edits`` in place of backpointers and the place before their first row.

    Parts come in descending order, so a task carries one place; the last part keeps its end in ``tail``.
    """
    out = pa.schema([*schema, ("start", pa.int32()), ("tail", pa.int32())])

    def run(batches):
        place = None
        for batch in batches:
            for i in range(batch.num_rows):
                part = batch.slice(i, 1).to_pylist()[0]
                tail = 0
                if part["last"]:
                    place = part["place"]
                    tail = TAIL[place]
                place, part["edits"] = follow(part["edits"], place)
                yield pa.RecordBatch.from_pylist([part | {"start": place, "tail": tail}], schema=out)

    return (parts.repartition("conv_id").sortWithinPartitions("conv_id", F.col("part").desc())
            .mapInArrow(run, from_arrow_schema(out)))


def _played(parts: DataFrame, schema: pa.Schema, edits: bool) -> DataFrame:
    """Results of the spilled conversations, from their decided parts in ascending order."""

    def rows(batches):
        digest, position = Digest(), 0
        for batch in batches:
            for i in range(batch.num_rows):
                part = batch.slice(i, 1).to_pylist()[0]
                if part["part"] == 0:
                    digest, position = Digest(), 0
                played = play(part["start"], part["edits"], part["roles"], part["texts"], part["tail"])
                if edits:
                    for edit, role, text in played:
                        yield {"conv_id": part["conv_id"], "position": position, "edit": edit, "role": role, "text": text}
                        position += 1
                else:
                    digest.add(played)
                    if part["last"]:
                        yield {k: part[k] for k in ("conv_id", *COUNTS)} | digest.result()

    def run(batches):
        yield from _batches(rows(batches), schema)

    return (parts.repartition("conv_id").sortWithinPartitions("conv_id", "part")
            .mapInArrow(run, from_arrow_schema(schema)))


def _repair(rows: DataFrame, edits: bool, held: tuple[int, int]) -> DataFrame:
    if "gone" not in rows.columns:
        rows = rows.select("conv_id", "turn", "role", "text").withColumn("gone", F.lit(False))
    rows = rows.withColumn("turn", F.col("turn").cast("long"))
    kind = to_arrow_type(rows.schema["conv_id"].dataType)
    result, both = _schema(kind, EDITS if edits else SUMMARY), dict(PARTS) | dict(SUMMARY) | (dict(EDITS) if edits else {})
    every = _schema(kind, both.items())

    def out(batches):
        for found in conversations(batches, held):
            if "part" in found:
                yield found
            elif edits:
                yield from _edits(found)
            else:
                yield _summary(found)

    def run(batches):
        yield from _batches(out(batches), every)

    found = stored(sorted_rows(rows).mapInArrow(run, from_arrow_schema(every)))
    parts = found.where(F.col("part").isNotNull())
    whole = found.where(F.col("part").isNull()).select(*result.names)
    if parts.isEmpty():
        return whole
    return whole.union(_played(stored(_decided(parts, every)), result, edits))


def repair(rows: DataFrame, held: tuple[int, int] = (HELD_ROWS, HELD_BYTES)) -> DataFrame:
    """(conv_id, position, edit, role, text): the cheapest edits of every conversation, in order.

    The repaired conversation is the rows whose edit is not D.
    """
    return _repair(rows, True, held)


def summary(rows: DataFrame, held: tuple[int, int] = (HELD_ROWS, HELD_BYTES)) -> DataFrame:
    """Counts of faults, cost, edit string and digest of the repaired rows, per conversation.

    ``rows`` may have a boolean ``gone``: such rows only name their conversation.
    """
    return _repair(rows, False, held)


def damage(rows: DataFrame) -> DataFrame:
    """Rows with faults made from crc32(conv_id:turn) % 20: dropped (``gone``), emptied, without stops, twice, as user."""
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    fault = F.crc32(F.concat(text["conv_id"], F.lit(":"), text["turn"]).cast("binary")) % 20
    marked = rows.select("conv_id", "turn", text["role"].alias("role"), text["text"].alias("text"), fault.alias("f"))
    return marked.select(
        "conv_id", "turn", F.when(F.col("f") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("f").isin(0, 1), "").when(F.col("f") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (F.col("f") == 0).alias("gone"),
        F.explode(F.when(F.col("f") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("times")).drop("times")


def op12_report(rows: DataFrame) -> DataFrame:
    """Faults, cheapest edits and digest of every conversation after damage."""
    return summary(damage(rows.select("conv_id", "turn", "role", "text")))

"""Repair of conversation structure by a cheapest list of edits, the audit.

A conversation's roles should read: perhaps a system turn, then user and assistant in turns,
ending with the assistant. Rows are kept, given another role or deleted, and empty turns are
inserted, at the least cost; of the cheapest lists the one least in ASCII order is taken.

The search is dynamic programming over the rows and four states (nothing yet, after system,
after user, after assistant). What one row may do is a table from state to state of a cost and
a label: the insertions before the row, then the row's edit. Labels of a row are prefix-free,
so of equally cheap ways into a state the one with the lesser text stays the lesser whatever
follows. Ways are persistent: a way is a node that links to the way it prolongs, knows its
ancestors 1, 2, 4, ... rows back and a rolling hash of its whole text, so prolonging shares
all of the prefix. Equally cheap ways are compared by a binary search, over these ancestors'
hashes, for the longest common prefix; equal hashes are verified by the nodes themselves, and
a collision falls back to comparing the texts.

How it runs on Spark: faults are told natively on rows that carry a digest in place of the
text. Such rows are dealt by ranges of conversation and turn, so a long conversation is spread
over tasks. A task folds each of its pieces (BLOCK rows at most) into one table from state to
state, the same kind of table as a row's, and a conversation's tables are folded in their
order. Texts are shuffled once, to the task that streams them into the digest of the repaired
conversation. That digest, and it alone, takes a conversation's texts one after another in one
task, since SHA-256 can't be split; only the hash's state and the audit are held there.

Defined results: a null in any column counts as one space (a null conv_id is a conversation,
returned as null); rows of one turn come in the order of role, then of a digest of the text;
equal rows are each a row, the later ones duplicates; an empty role has an empty initial and
makes no legal pair; a conversation without rows after the damage has zeros, an empty audit and
the empty text's hash; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quittance.llm.common import narrow_batches, rows, store

#: White space: \x20 and \x09 to \x0D.
BLANKS = " \t\n\x0b\x0c\r"
#: Rows folded into one table.
BLOCK = 8_192

# ---- edits -------------------------------------------------------------------------------

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: The state that a turn of a role leads to.
_NEXT = {
    (START, "s"): SYSTEM,
    (START, "u"): USER,
    (SYSTEM, "u"): USER,
    (USER, "a"): ASSISTANT,
    (ASSISTANT, "u"): USER,
}
_NAMES = {USER: "user", ASSISTANT: "assistant"}
#: The one state that an inserted or given role leads to.
_GIVEN = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
#: A row that must be deleted; other rows are the initial of their role, a capital if truncated.
GONE = "x"
LEGAL = {"su", "ua", "au"}

#: From state to state: cost and label.
Table = dict[int, dict[int, tuple[int, str]]]


def _row_table(symbol: str) -> Table:
    truncated = TRUNCATED if symbol.isupper() else 0
    table: Table = {}
    for start in STATES:
        found: dict[int, tuple[int, str]] = {}
        state, cost, label = start, 0, ""
        for _ in range(3):  # a third insertion leads where the first has led
            ways = [(state, DELETE, "D")]
            if symbol != GONE:
                ways.append((_GIVEN[state], REROLE + truncated, "R"))
                if (state, symbol.lower()) in _NEXT:
                    ways.append((_NEXT[state, symbol.lower()], KEEP + truncated, "K"))
            for end, price, letter in ways:
                way = (cost + price, label + letter)
                found[end] = min(found.get(end, way), way)
            state, cost, label = _GIVEN[state], cost + INSERT, label + "I"
        table[start] = found
    return table


ROW_TABLES = {s: _row_table(s) for s in ["s", "u", "a", "o", "S", "U", "A", "O", GONE]}
#: What completes a conversation from a state.
ENDINGS = {START: (0, ""), SYSTEM: (2 * INSERT, "II"), USER: (INSERT, "I"), ASSISTANT: (0, "")}


# ---- persistent ways ---------------------------------------------------------------------

_PRIME, _BASE = (1 << 61) - 1, 1_000_003_579


class Label:
    """A text with the numbers that put it behind a rolling hash."""

    __slots__ = ("text", "hash", "power")

    def __init__(self, text: str, prime: int = _PRIME) -> None:
        self.text, self.hash = text, 0
        for letter in text.encode("ascii"):
            self.hash = (self.hash * _BASE + letter) % prime
        self.power = pow(_BASE, len(text), prime)


class Ways:
    """A forest of ways; a node is a number, 0 the way without edits."""

    def __init__(self, prime: int = _PRIME) -> None:
        self.prime = prime
        self.labels: list[Label | None] = [None]
        self.hashes, self.up = [0], [[]]  # up[n][k]: the ancestor 2^k rows back

    def prolong(self, node: int, label: Label) -> int:
        ancestors, k = [node], 0
        while k < len(self.up[ancestors[k]]):
            ancestors.append(self.up[ancestors[k]][k])
            k += 1
        self.labels.append(label)
        self.hashes.append((self.hashes[node] * label.power + label.hash) % self.prime)
        self.up.append(ancestors)
        return len(self.labels) - 1

    def less(self, one: tuple[int, Label], other: tuple[int, Label]) -> bool:
        """Whether one way with a label behind it comes before another of as many rows."""
        (a, last), (b, other_last) = one, other
        if a == b:
            return last.text < other_last.text
        if self.hashes[a] == self.hashes[b]:
            if self._same(a, b):
                return last.text < other_last.text
            return self.text(a) < self.text(b)
        for k in range(len(self.up[a]) - 1, -1, -1):
            if k < len(self.up[a]) and self.hashes[self.up[a][k]] != self.hashes[self.up[b][k]]:
                a, b = self.up[a][k], self.up[b][k]
        if self._same(self.up[a][0], self.up[b][0]):  # the common prefix; then the first other label
            return self.labels[a].text < self.labels[b].text
        return self.text(one[0]) < self.text(other[0])

    def _same(self, a: int, b: int) -> bool:
        """Whether nodes with equal hashes hold the same text."""
        while a != b:
            if self.labels[a].text != self.labels[b].text:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def text(self, node: int) -> str:
        parts = []
        while node:
            parts.append(self.labels[node].text)
            node = self.up[node][0]
        return "".join(reversed(parts))


_LABELS: dict[str, Label] = {}


def _label(text: str) -> Label:
    return _LABELS.setdefault(text, Label(text)) if len(text) <= 3 else Label(text)


class Fold:
    """The cheapest ways from one state through tables in a row."""

    def __init__(self, start: int) -> None:
        self.ways, self.best = Ways(), {start: (0, 0)}  # state: cost, node

    def add(self, table: Table) -> None:
        found: dict[int, tuple[int, int, Label]] = {}
        for state, (cost, node) in self.best.items():
            for end, (price, text) in table[state].items():
                total, held = cost + price, found.get(end)
                if held is not None and held[0] < total:
                    continue
                label = _label(text)
                if held is None or total < held[0] or self.ways.less((node, label), held[1:]):
                    found[end] = (total, node, label)
        self.best = {end: (cost, self.ways.prolong(node, label)) for end, (cost, node, label) in found.items()}

    def texts(self) -> dict[int, tuple[int, str]]:
        return {end: (cost, self.ways.text(node)) for end, (cost, node) in self.best.items()}


def finish(ends: dict[int, tuple[int, str]]) -> tuple[int, str]:
    """Cost and audit of a whole conversation from what leads to each state."""
    return min((cost + ENDINGS[s][0], text + ENDINGS[s][1]) for s, (cost, text) in ends.items())


def _fold(symbols: str, starts: tuple[int, ...]) -> Table:
    table = {}
    for start in starts:
        fold = Fold(start)
        for symbol in symbols:
            fold.add(ROW_TABLES[symbol])
        table[start] = fold.texts()
    return table


#: Most conversations are short, and there are few kinds of rows.
_folded = lru_cache(maxsize=1 << 14)(_fold)


def fold_rows(symbols: str, starts: tuple[int, ...] = (START,)) -> Table:
    return _folded(symbols, starts) if len(symbols) <= 32 else _fold(symbols, starts)


# ---- damage ------------------------------------------------------------------------------


def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text`` and how often the row is there (``copies``, perhaps 0)."""
    space = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    named = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        space("role").alias("role"),
        space("text").alias("text"),
        kind.alias("kind"),
    )
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return named.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).alias("copies"),
    )


# ---- faults and pieces -------------------------------------------------------------------


def _digest() -> Column:
    return F.substring(F.unhex(F.sha2("text", 256)), 1, 16).alias("digest")


def faults(damaged: DataFrame) -> DataFrame:
    """One row for all equal ones: ``copies``, ``initial``, ``blank``, ``truncated``, and ``again``
    if an earlier turn of the conversation has said the same."""
    stripped = F.rtrim("text", F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    narrow = damaged.select(
        "conv_id",
        "turn",
        "role",
        _digest(),
        F.col("copies").cast("long").alias("copies"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"),
        (stripped == "").alias("blank"),
        (~F.right(stripped, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
    )
    same = ["conv_id", "turn", "role", "digest", "initial", "blank", "truncated"]
    told = store(narrow.groupBy(*same).agg(F.sum("copies").alias("copies")))
    order = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"))
    said = told.where("copies > 0").groupBy("conv_id", "role", "digest")
    repeated = said.agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1").select(
        F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first"
    )
    same_text = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    again = F.coalesce(order > F.col("first"), F.lit(False)).alias("again")
    return told.join(repeated, same_text, "left").select(*told.columns, again)


_TABLE = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
_PIECE_NAMES = ["blank", "duplicate", "truncated", "illegal", "rows", "turns", "least", "most", "first", "last"]
_PIECE = pa.schema(
    [("conv_id", pa.int64()), ("part", pa.int32()), ("number", pa.int32())]
    + [(n, pa.int64()) for n in _PIECE_NAMES[:8]]
    + [("first", pa.string()), ("last", pa.string()), ("ways", _TABLE)]
)
_PIECE_FIELDS = (
    "conv_id long, part int, number int, "
    + ", ".join(f"{n} long" for n in _PIECE_NAMES[:8])
    + ", first string, last string, ways array<struct<start: int, end: int, cost: long, audit: string>>"
)


class _Piece:
    """Rows of one conversation in order."""

    def __init__(self, conv_id: int | None, starts: tuple[int, ...]) -> None:
        self.conv_id, self.starts = conv_id, starts
        self.symbols: list[str] = []
        self.blank = self.duplicate = self.truncated = self.illegal = self.rows = self.turns = 0
        self.least = self.most = None
        self.first = self.last = None

    def add(self, turn: int | None, initial: str, blank: bool, truncated: bool, again: bool) -> None:
        if blank:
            self.blank, symbol = self.blank + 1, GONE
        elif again:
            self.duplicate, symbol = self.duplicate + 1, GONE
        elif truncated:
            self.truncated, symbol = self.truncated + 1, initial.upper()
        else:
            symbol = initial
        self.symbols.append(symbol)
        self.rows += 1
        if self.last is None:
            self.first = initial
        elif self.last + initial not in LEGAL:
            self.illegal += 1
        self.last = initial
        if turn is not None and turn != self.most:
            self.turns, self.most = self.turns + 1, turn
            self.least = turn if self.least is None else self.least

    def values(self, part: int, number: int) -> tuple:
        table = fold_rows("".join(self.symbols), self.starts)
        ways = [{"start": s, "end": e, "cost": c, "audit": a} for s, ends in table.items() for e, (c, a) in ends.items()]
        return (self.conv_id, part, number, *[getattr(self, n) for n in _PIECE_NAMES], ways)


def pieces(marked: DataFrame, block: int = BLOCK) -> DataFrame:
    """Tables and counts of pieces of conversations; ``part`` and ``number`` give their order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, piece, done = TaskContext.get().partitionId(), 0, None, []
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                conv_id, turn, copies, initial, blank, truncated, again = row
                # what begins inside a partition begins its conversation
                starts = (START,) if piece is not None and conv_id != piece.conv_id else tuple(STATES)
                if piece is None or conv_id != piece.conv_id:
                    if piece is not None:
                        done.append(piece.values(part, number))
                        number += 1
                    piece = _Piece(conv_id, starts)
                for copy in range(copies):
                    if piece.rows >= block:
                        done.append(piece.values(part, number))
                        number, piece = number + 1, _Piece(conv_id, tuple(STATES))
                    piece.add(turn, initial, blank, truncated, again or copy > 0)
                if len(done) >= 1000:
                    yield rows(_PIECE, *map(list, zip(*done, strict=True)))
                    done = []
        if piece is not None:
            done.append(piece.values(part, number))
            yield rows(_PIECE, *map(list, zip(*done, strict=True)))

    keys = ["conv_id", "turn", "role", "digest"]
    dealt = marked.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return dealt.select("conv_id", "turn", "copies", "initial", "blank", "truncated", "again").mapInArrow(run, _PIECE_FIELDS)


# ---- whole conversations -----------------------------------------------------------------


class Conversation:
    """Adds up a conversation's pieces in order, then streams its texts through the repair."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.fold = conv_id, Fold(START)
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.least = self.most = self.last = None
        self.audit: str | None = None
        self.place, self.state, self.hash, self.said = 0, START, hashlib.sha256(), False

    def add(self, piece: dict) -> None:
        if not piece["rows"]:
            return
        for name in ("blank", "duplicate", "truncated", "illegal", "turns"):
            setattr(self, name, getattr(self, name) + piece[name])
        if self.last is not None and self.last + piece["first"] not in LEGAL:
            self.illegal += 1
        self.last = piece["last"]
        if piece["least"] is not None:
            if piece["least"] == self.most:  # a turn that goes on in this piece
                self.turns -= 1
            self.least = piece["least"] if self.least is None else self.least
            self.most = piece["most"]
        table: Table = {}
        for way in piece["ways"]:
            table.setdefault(way["start"], {})[way["end"]] = (way["cost"], way["audit"])
        self.fold.add(table)

    def decide(self) -> None:
        if self.audit is None:
            self.cost, self.audit = finish(self.fold.texts())

    def _say(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.said else "") + f"{role}:{text}").encode("utf-8"))
        self.said = True

    def _insert(self) -> None:
        while self.place < len(self.audit) and self.audit[self.place] == "I":
            self.state = _GIVEN[self.state]
            self._say(_NAMES[self.state], "")
            self.place += 1

    def read(self, role: str, text: str) -> None:
        """The next row after the damage."""
        self.decide()
        self._insert()
        edit = self.audit[self.place]
        self.place += 1
        if edit == "K":
            self.state = _NEXT[self.state, role[:1]]
            self._say(role, text)
        elif edit == "R":
            self.state = _GIVEN[self.state]
            self._say(_NAMES[self.state], text)

    def result(self) -> tuple:
        self.decide()
        self._insert()
        gaps = self.most - self.least + 1 - self.turns if self.turns else 0
        counts = (gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost)
        return (self.conv_id, *counts, self.audit, self.hash.hexdigest())


_RESULT_NAMES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_RESULT = pa.schema(
    [("conv_id", pa.int64()), *[(n, pa.int64()) for n in _RESULT_NAMES], ("audit", pa.string()), ("repaired_sha256", pa.string())]
)
_RESULT_FIELDS = "conv_id long, " + ", ".join(f"{n} long" for n in _RESULT_NAMES) + ", audit string, repaired_sha256 string"


def repair(damaged: DataFrame, block: int = BLOCK) -> DataFrame:
    """Faults, audit and digest of every conversation of rows with ``copies``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by conversation: its pieces in order, then its texts in order."""
        current, done = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if current is None or row["conv_id"] != current.conv_id:
                    if current is not None:
                        done.append(current.result())
                    current = Conversation(row["conv_id"])
                if row["part"] >= 0 and row["ways"] is not None:
                    current.add(row)
                else:
                    for _ in range(row["copies"]):
                        current.read(row["role"], row["text"])
            if done:
                yield rows(_RESULT, *map(list, zip(*done, strict=True)))
                done = []
        if current is not None:
            yield rows(_RESULT, *map(list, zip(*[*done, current.result()], strict=True)))

    narrow_batches(damaged)
    tables = pieces(faults(damaged), block)
    texts = damaged.where("copies > 0").select("conv_id", F.lit(1).alias("is_text"), "turn", "role", _digest(), "text", "copies")
    together = tables.withColumn("is_text", F.lit(0)).unionByName(texts, allowMissingColumns=True)
    together = together.withColumn("part", F.coalesce("part", F.lit(-1)))
    order = ["conv_id", "is_text", "part", "number", "turn", "role", "digest"]
    by_conversation = together.repartition("conv_id").sortWithinPartitions(*order)
    return by_conversation.drop("digest", "turn", "number").mapInArrow(run, _RESULT_FIELDS)


def damage_and_repair(conversations: DataFrame) -> DataFrame:
    return repair(damage(conversations))


ORACLE = r"""
with recursive given as (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
        -- CRC-32 of conv_id:turn, bit by bit
        xor(list_reduce(
            list_prepend(4294967295::bigint, list_transform(
                string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda c: ascii(c)::bigint)),
            lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda a, k: xor(a >> 1, (a & 1) * 3988292384))
        ), 4294967295::bigint) % 20 as kind
    from conversations
),
damaged as (
    select conv_id, turn, case when kind = 4 then 'user' else role end as role,
        case kind when 1 then '' when 2 then translate(text, '.!?', '') else text end as text,
        unnest(range(case kind when 0 then 0 when 3 then 2 else 1 end)) as copy
    from given
),
placed as (
    select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text), copy) as place,
        trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as solid
    from damaged
),
told as (
    select *, role[1:1] as initial, lag(role[1:1]) over (partition by conv_id order by place) as before,
        case
            when solid = '' then 'blank'
            when row_number() over (partition by conv_id, role, text order by place) > 1 then 'duplicate'
            when right(solid, 1) not in ('.', '!', '?') then 'truncated'
            else 'none'
        end as fault
    from placed
),
-- states: nothing yet 0, after system 1, after user 2, after assistant 3; where insertions lead
inserted(origin, used, state) as (
    values (0, 0, 0), (0, 1, 2), (0, 2, 3), (1, 0, 1), (1, 1, 2), (1, 2, 3), (2, 0, 2), (2, 1, 3), (3, 0, 3), (3, 1, 2)
),
-- where an edit of a row with an initial leads; null: any initial
edits(letter, price, state, initial, ending) as (
    values ('D', 2, 0, null, 0), ('D', 2, 1, null, 1), ('D', 2, 2, null, 2), ('D', 2, 3, null, 3),
        ('R', 1, 0, null, 2), ('R', 1, 1, null, 2), ('R', 1, 2, null, 3), ('R', 1, 3, null, 2),
        ('K', 0, 0, 's', 1), ('K', 0, 0, 'u', 2), ('K', 0, 1, 'u', 2), ('K', 0, 2, 'a', 3), ('K', 0, 3, 'u', 2)
),
ways as (
    select distinct conv_id, 0::bigint as place, 0 as state, {'cost': 0, 'audit': ''} as way from conversations
    union all
    select ways.conv_id, told.place, edits.ending, min({
            'cost': ways.way.cost + 5 * used + price + case when fault = 'truncated' and letter <> 'D' then 5 else 0 end,
            'audit': ways.way.audit || repeat('I', used::bigint) || letter
        })
    from ways
    join told on told.conv_id is not distinct from ways.conv_id and told.place = ways.place + 1
    join inserted on inserted.origin = ways.state
    join edits on edits.state = inserted.state and coalesce(edits.initial, told.initial) = told.initial
        and (letter = 'D' or fault not in ('blank', 'duplicate'))
    group by ways.conv_id, told.place, edits.ending
),
lengths as (select conv_id, max(place) as n from ways group by conv_id),
best as (
    select ways.conv_id, min({'cost': way.cost + 5 * used, 'audit': way.audit || repeat('I', used::bigint)}) as way
    from ways
    join lengths on lengths.conv_id is not distinct from ways.conv_id and lengths.n = ways.place
    join inserted on inserted.origin = ways.state and inserted.state in (0, 3)
    group by ways.conv_id
),
letters as (
    select conv_id, i, way.audit[i:i] as letter from (select conv_id, way, unnest(range(1, length(way.audit) + 1)) as i from best)
),
met as (
    select *, sum((letter <> 'I')::int) over before as place, sum((letter <> 'D')::int) over before as said
    from letters window before as (partition by conv_id order by i)
),
lines as (
    select met.conv_id, i, letter, said, role, text,
        max((said = 1 and letter = 'K' and initial = 's')::int) over (partition by met.conv_id) as system
    from met left join told on told.conv_id is not distinct from met.conv_id and told.place = met.place and letter <> 'I'
),
repaired as (
    select conv_id, string_agg(
            case when letter = 'K' then role when (said - system) % 2 = 1 then 'user' else 'assistant' end
            || ':' || case when letter = 'I' then '' else text end, chr(10) order by i) filter (letter <> 'D') as text
    from lines group by conv_id
),
faults as (
    select conv_id, max(turn) - min(turn) + 1 - count(distinct turn) as gaps, count(*) filter (fault = 'blank') as blank,
        count(*) filter (fault = 'duplicate') as duplicate, count(*) filter (fault = 'truncated') as truncated,
        count(*) filter (before is not null and before || initial not in ('su', 'ua', 'au')) as illegal
    from told group by conv_id
)
select best.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
    coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, best.way.cost::bigint as cost, best.way.audit as audit,
    sha256(coalesce(repaired.text, '')) as repaired_sha256
from best
left join faults on faults.conv_id is not distinct from best.conv_id
left join repaired on repaired.conv_id is not distinct from best.conv_id
"""

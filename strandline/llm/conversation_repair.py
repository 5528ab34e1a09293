"""Damaging and repairing the structure of conversations: which rows are faulty, and the cheapest edits that make turns alternate.

A repaired conversation's role initials are ``s?(ua)+`` or nothing. Edits, one for each row and between rows: Keep costs 0, Rerole to user or
assistant 3, Delete 4 (blank rows and duplicates must go), Insert an empty user or assistant row 3; truncated rows that stay
cost 3 more. Of the cheapest edits those count whose initials (D, I, K, R) come first in ASCII.

The search is depth-first branch-and-bound: an explicit stack of prefixes, the next edit in ASCII order first; a lower bound of what the
rows that follow cost at least; the incumbent, a complete (cost, audit); and for each node, a place and a state of the
roles so far (nothing, system, user, assistant), the best (cost, audit) that reached it. A prefix that isn't below its node's entry, or whose cost and bound
exceed the incumbent's, is dropped. Of one place and state the better prefix stays better whatever follows, as no optimal audit begins with
another one of equal cost; so when the stack is empty the incumbent is proved optimal.

Rows are dealt by conversation and sorted, and a conversation of up to ``LONG`` rows is solved as it streams by. Longer ones are cut into tiles
of so many rows, dealt out each on its own and solved from each state to each; the tiles of a conversation are then joined in order, and a second pass over the
tiles renders what was chosen. So only the audit and one digest of a conversation pass one task, which are single values of the result.

Null roles, texts and turns (in the damaging hash) are one space, as the contract of the query says; null turns come first and null
conversation ids are one conversation. Rows of one turn are in order of role and text, repeated rows next to each other, each a
row. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandline.lineage import cut_lineage
from strandline.llm.common import table

LONG = 1 << 12
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: States: nothing yet, after system, after user, after assistant; and what may follow each: (role initial, next state).
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {NOTHING: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
STATES, ENDS = (NOTHING, SYSTEM, USER, ASSISTANT), (NOTHING, ASSISTANT)
#: What a row is: its role's initial and its fault, none, blank, duplicate or truncated.
FINE, BLANK, DUPLICATE, CUT = range(4)
_WORD = re.compile(r"[^\x20\x09-\x0D]")
_LAST = re.compile(r"[^\x20\x09-\x0D][\x20\x09-\x0D]*\Z")


def damaged(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) of rows, damaged by the checksum of conv_id and turn: a fifth of the table or so."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    own = rows.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), kind.alias("__kind")).filter("__kind <> 0")
    text = F.when(F.col("__kind") == 1, "").when(F.col("__kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("__kind") == 4, "user").otherwise(F.col("role"))
    return own.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.when(F.col("__kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def solve(rows: list[tuple[str, int]], begin: int = NOTHING, ends: tuple = ENDS) -> tuple[int, str] | None:
    """The cheapest (cost, audit) from state ``begin`` to one of ``ends`` over rows (role initial, fault); None if there is no way."""
    n = len(rows)
    rest = [0] * (n + 1)  # what each suffix costs at least
    for i in range(n - 1, -1, -1):
        initial, fault = rows[i]
        least = DELETE if fault in (BLANK, DUPLICATE) else 0 if initial in "sua" and initial else REROLE
        rest[i] = rest[i + 1] + min(least + (TRUNCATED if fault == CUT else 0), DELETE)
    best: tuple[int, str] | None = None
    reached: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, begin, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        node, own = (i, state), (cost, audit)
        if node in reached and reached[node] < own or best and cost + rest[i] > best[0]:
            continue
        if i == n and state in ends and (not best or own < best):
            best = own
        ways = []
        if i < n:
            initial, fault = rows[i]
            ways.append((i + 1, state, cost + DELETE, audit + "D"))
        ways += [(i, after, cost + INSERT, audit + "I") for role, after in NEXT[state].items() if role != "s"]
        if i < n and fault not in (BLANK, DUPLICATE):
            more = cost + (TRUNCATED if fault == CUT else 0)
            if initial in NEXT[state]:
                ways.append((i + 1, NEXT[state][initial], more, audit + "K"))
            ways += [(i + 1, after, more + REROLE, audit + "R") for role, after in NEXT[state].items() if role != "s"]
        for way in reversed(ways):
            node, own = way[:2], way[2:]
            if (node not in reached or own < reached[node]) and not (best and own[0] + rest[way[0]] > best[0]):
                reached[node] = own
                stack.append(way)
    return best


def rendered(rows: list[tuple[str, str]], audit: str, begin: int = NOTHING) -> tuple[list[str], int]:
    """The repaired lines of rows (role, text) and the state at their end."""
    out, i, state = [], 0, begin
    for edit in audit:
        if edit == "D":
            i += 1
            continue
        role, text = ("", "") if edit == "I" else rows[i]
        if edit != "K":
            role = "assistant" if state == USER else "user"
        out.append(f"{role}:{text}")
        state = NEXT[state][role[0]]
        i += edit != "I"
    return out, state


def fault_of(role: str, text: str, again: bool) -> int:
    if not _WORD.search(text):
        return BLANK
    if again:
        return DUPLICATE
    return FINE if _LAST.search(text).group()[0] in ".!?" else CUT


class Tally:
    """What is counted over the rows of a conversation, or of a tile, in order."""

    def __init__(self):
        self.n = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.low = self.high = None

    def row(self, turn, initial: str, fault: int) -> None:
        self.blank += fault == BLANK
        self.duplicate += fault == DUPLICATE
        self.truncated += fault == CUT
        if self.n:
            self.illegal += self.last + initial not in ("su", "ua", "au")
        else:
            self.first = initial
        self.last, self.n = initial, self.n + 1
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn

    def join(self, other: Tally) -> None:
        if not self.n:
            self.__dict__.update(other.__dict__)
            return
        self.illegal += other.illegal + (self.last + other.first not in ("su", "ua", "au"))
        self.turns += other.turns - (other.low is not None and other.low == self.high)
        for c in ("n", "blank", "duplicate", "truncated"):
            setattr(self, c, getattr(self, c) + getattr(other, c))
        self.last = other.last
        self.low = other.low if self.low is None else self.low
        self.high = self.high if other.high is None else other.high

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def repaired(rows: list[tuple]) -> tuple:
    """The result's values for the whole rows (turn, role, text) of a conversation, in order."""
    seen, tally, plain = set(), Tally(), []
    for turn, role, text in rows:
        fault = fault_of(role, text, (role, text) in seen)
        seen.add((role, text))
        tally.row(turn, role[:1], fault)
        plain.append((role[:1], fault))
    cost, audit = solve(plain)
    lines, _ = rendered([r[1:] for r in rows], audit)
    return tally.gaps, tally.blank, tally.duplicate, tally.truncated, tally.illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def _groups(batches, key: str, columns: list[str]):
    """(key, rows) of each run of rows with one key."""
    now, held = None, []
    for b in batches:
        keys = b.column(key).to_pylist()
        for k, row in zip(keys, zip(*[b.column(c).to_pylist() for c in columns], strict=True), strict=True):
            if held and k != now:
                yield now, held
                held = []
            now = k
            held.append(row)
    if held:
        yield now, held


def _batch(rows: list[tuple], names: str) -> pa.RecordBatch:
    types = {"long": pa.int64(), "string": pa.string(), "int": pa.int32(), "array<string>": pa.list_(pa.string()), "array<long>": pa.list_(pa.int64())}
    fields = [x.strip().split(" ") for x in names.split(",")]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], types[t]) for k, (_, t) in enumerate(fields)], [n for n, _ in fields])


def _streamed(groups, f, names: str, most: int = 500):
    held = []
    for key, rows in groups:
        held += f(key, rows)
        if len(held) >= most:
            yield _batch(held, names)
            held = []
    if held:
        yield _batch(held, names)


def repair(rows: DataFrame, long: int = LONG) -> DataFrame:
    """Rows (conv_id, RESULT) for each conv_id of rows (conv_id, turn, role, text), which are taken as they are."""
    rows = rows.select(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("conv"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    large = cut_lineage(rows.groupBy("conv").agg(F.count("*").alias("n")).filter(F.col("n") > long).select("conv"))
    order = [F.asc_nulls_first("turn"), "role", "text"]
    short = rows.join(large, "conv", "left_anti").repartition("conv").sortWithinPartitions("conv", *order)
    whole = f"conv string, {RESULT}"
    out = short.mapInArrow(lambda b: _streamed(_groups(b, "conv", ["turn", "role", "text"]), lambda k, r: [(k, *repaired(r))], whole), whole)
    return out if large.isEmpty() else out.unionAll(tiled(rows.join(large, "conv", "left_semi"), long))


TILE = "conv string, tile string, place long, tally array<long>, ends array<string>, ways array<string>"


def tiled(rows: DataFrame, size: int) -> DataFrame:
    """``repair`` for conversations of any length, in tiles of up to ``size`` rows: rows (conv, turn, role, text)."""
    from pyspark import TaskContext

    order = [F.asc_nulls_first("turn"), "role", "text", "id"]
    numbered = cut_lineage(rows.withColumns({"id": F.monotonically_increasing_id(), "mark": F.sha2(F.concat_ws("\x00", "role", "text"), 256)}))
    # a text seen earlier: not the first row of its kind, in the order of the conversation
    kinds = numbered.groupBy("conv", "mark").agg(F.min(F.struct(F.col("turn").isNotNull().alias("k"), "turn", "role", "text", "id"))["id"].alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    marked = numbered.join(kinds, ["conv", "mark"], "left").withColumn("again", F.coalesce(F.col("first") != F.col("id"), F.lit(False)))
    sorted_ = marked.select("conv", "turn", "role", "text", "id", "again").repartitionByRange("conv", *order).sortWithinPartitions("conv", *order)

    def cut(batches):
        part, number, now, n = TaskContext.get().partitionId() << 40, 0, None, 0
        for b in batches:
            places = []
            for conv in b.column("conv").to_pylist():
                if conv != now or n == size:
                    now, n, number = conv, 0, number + 1
                n += 1
                places.append(part + (number << 13) + n)
            yield pa.RecordBatch.from_arrays([b.column("conv"), pa.array(places, pa.int64()), *[b.column(c) for c in ("turn", "role", "text", "again")]], ["conv", "place", "turn", "role", "text", "again"])

    if size >= 1 << 13:
        raise ValueError("a tile has fewer than 8,192 rows")
    tiles = cut_lineage(sorted_.mapInArrow(cut, "conv string, place long, turn long, role string, text string, again boolean").withColumn("tile", F.concat_ws("/", "conv", F.shiftright("place", 13).cast("string"))))
    dealt = tiles.repartition("tile").sortWithinPartitions("tile", "place")

    def ways(tile, rows_):
        tally, plain = Tally(), []
        for _, _, turn, role, text, again in rows_:
            fault = fault_of(role, text, again)
            tally.row(turn, role[:1], fault)
            plain.append((role[:1], fault))
        found = [solve(plain, a, (z,)) for a in STATES for z in STATES]
        t = tally
        conv, place = rows_[0][:2]
        return [(conv, tile, place, [t.n, t.blank, t.duplicate, t.truncated, t.illegal, t.turns, t.low, t.high], [t.first, t.last], [None if x is None else f"{x[0]} {x[1]}" for x in found])]

    solved = dealt.mapInArrow(lambda b: _streamed(_groups(b, "tile", ["conv", "place", "turn", "role", "text", "again"]), ways, TILE, 50), TILE)

    def joined(conv, rows_):
        tally, best, chain = Tally(), {NOTHING: (0, "", NOTHING)}, []
        for _, counts, ends, found in rows_:
            t = Tally()
            t.n, t.blank, t.duplicate, t.truncated, t.illegal, t.turns, t.low, t.high = counts
            t.first, t.last = ends
            tally.join(t)
            split = [None if x is None else x.partition(" ") for x in found]
            new, back = {}, {}
            for a, (cost, audit, _) in best.items():
                for z in STATES:
                    if way := split[4 * a + z]:
                        own = (cost + int(way[0]), audit + way[2])
                        if z not in new or own < new[z][:2]:
                            new[z] = (*own, a)
                            back[z] = a, way[2]
            best = new
            chain.append(back)
        state = min((z for z in ENDS if z in best), key=lambda z: best[z][:2])
        cost, audit, _ = best[state]
        chosen = []
        for (tile, *_), back in zip(reversed(rows_), reversed(chain), strict=True):
            begin, part = back[state]
            chosen.append((conv, tile, begin, part))
            state = begin
        values = [tally.gaps, tally.blank, tally.duplicate, tally.truncated, tally.illegal, cost]
        return [(conv, None, None, audit, values), *[(*c, None) for c in chosen]]

    names = "conv string, tile string, begin long, audit string, counted array<long>"
    one = solved.repartition("conv").sortWithinPartitions("conv", "place")
    chosen = cut_lineage(one.mapInArrow(lambda b: _streamed(_groups(b, "conv", ["tile", "tally", "ends", "ways"]), joined, names, 1), names))

    def lines(tile, rows_):
        conv, place, _, _, begin, audit = rows_[0]
        return [(conv, place, "\n".join(rendered([r[2:4] for r in rows_], audit, begin)[0]), int(any(e != "D" for e in audit)))]

    texts = "conv string, place long, lines string, some int"
    pieces = tiles.join(chosen.filter("tile is not null").select("tile", "begin", "audit"), "tile").repartition("tile").sortWithinPartitions("tile", "place")
    rendered_ = pieces.mapInArrow(lambda b: _streamed(_groups(b, "tile", ["conv", "place", "role", "text", "begin", "audit"]), lines, texts, 20), texts)

    def digests(batches):
        now, sha, begun = None, None, False
        for b in batches:
            for conv, text, some in zip(*[b.column(c).to_pylist() for c in ("conv", "lines", "some")], strict=True):
                if sha is None or conv != now:
                    if sha:
                        yield _batch([(now, sha.hexdigest())], "conv string, sha string")
                    now, sha, begun = conv, hashlib.sha256(), False
                if some:
                    sha.update((("\n" if begun else "") + text).encode())
                    begun = True
        if sha:
            yield _batch([(now, sha.hexdigest())], "conv string, sha string")

    sha = rendered_.repartition("conv").sortWithinPartitions("conv", "place").mapInArrow(digests, "conv string, sha string")
    counted = [F.get("counted", k).alias(c) for k, c in enumerate(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"))]
    return chosen.filter("tile is null").select("conv", *counted, "audit").join(sha, "conv").withColumnRenamed("sha", "repaired_sha256")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "conversations")
    found = repair(damaged(own))
    ids = own.select("conv_id").distinct().withColumn("conv", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")))
    zeros = {c: 0 for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return ids.join(found, "conv", "left").drop("conv").fillna(zeros | {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}, [*zeros, "audit", "repaired_sha256"])


#: The steps of a checksum's byte as a list of 256, and the search as a table of states, best way by state, row by row.
_CRC = "list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"


def _ways() -> str:
    """The state after a row: for each of four states the least (cost, audit, text) over what leads there."""
    add = lambda old, cost, edit, line=None: f"CASE WHEN {old} IS NOT NULL THEN {{'c': {old}.c + {cost}, 'a': {old}.a || '{edit}', 't': " + (f"{old}.t || CASE WHEN {old}.t = '' THEN '' ELSE chr(10) END || {line}" if line else f"{old}.t") + "} END"
    least = lambda xs: "list_min(list_filter([" + ", ".join(xs) + "], lambda x: x IS NOT NULL))"
    s = [f"r.s{k}" for k in range(4)]
    user, assistant = "'user:'", "'assistant:'"
    # inserts first: i2 is a user after nothing, system or assistant; i3 an assistant after a user; none does both
    insert_u = least([s[2], *[add(x, 3, "I", user) for x in (s[0], s[1], s[3])]])
    insert_a = least([s[3], add(s[2], 3, "I", assistant), *[add(x, 6, "II", user + " || chr(10) || " + assistant) for x in (s[0], s[1])]])
    base = ["s0", "s1", "i2", "i3"]
    deleted = [add(f"b.{x}", 4, "D") for x in base]
    stays = lambda x: f"CASE WHEN b.fault IN (0, 3) THEN {x} END"
    more = "(CASE WHEN b.fault = 3 THEN 3 ELSE 0 END)"
    kept = lambda initial, olds: [stays(f"CASE WHEN b.initial = '{initial}' THEN {add('b.' + o, more, 'K', 'b.line')} END") for o in olds]
    turned = lambda role, olds: [stays(add("b." + o, f"(3 + {more})", "R", f"'{role}:' || b.text")) for o in olds]
    after = [least([deleted[0]]), least([deleted[1], *kept("s", ["s0"])]), least([deleted[2], *kept("u", ["s0", "s1", "i3"]), *turned("user", ["s0", "s1", "i3"])]), least([deleted[3], *kept("a", ["i2"]), *turned("assistant", ["i2"])])]
    return insert_u, insert_a, after


_U, _A, _AFTER = _ways()
ORACLE = f"""WITH RECURSIVE crc AS (SELECT {_CRC} AS steps),
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
h AS (SELECT k.*, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(name, ''), lambda c: ascii(c)::BIGINT)), lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind FROM k, crc),
d AS (SELECT conv_id, turn, copy, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text FROM (SELECT *, unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy FROM h WHERE kind <> 0)),
o AS (SELECT *, row_number() OVER w AS k, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again, lag(role) OVER w AS before FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
f AS (SELECT *, left(role, 1) AS initial, role || ':' || text AS line, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 1 WHEN again THEN 2 WHEN regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 0 ELSE 3 END AS fault FROM o),
r AS (SELECT DISTINCT conv_id, 0::BIGINT AS k, {{'c': 0, 'a': '', 't': ''}} AS s0, NULL::STRUCT(c INTEGER, a VARCHAR, t VARCHAR) AS s1, NULL::STRUCT(c INTEGER, a VARCHAR, t VARCHAR) AS s2, NULL::STRUCT(c INTEGER, a VARCHAR, t VARCHAR) AS s3 FROM f
  UNION ALL SELECT conv_id, k, {_AFTER[0]}, {_AFTER[1]}, {_AFTER[2]}, {_AFTER[3]} FROM (SELECT f.*, r.s0, r.s1, {_U} AS i2, {_A} AS i3 FROM r JOIN f ON f.conv_id IS NOT DISTINCT FROM r.conv_id AND f.k = r.k + 1) b),
z AS (SELECT r.conv_id, list_min(list_filter([s0, {_A}], lambda x: x IS NOT NULL)) AS best FROM r JOIN (SELECT conv_id, max(k) AS k FROM f GROUP BY 1) USING (conv_id, k)),
n AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (k > 1 AND left(before, 1) || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY 1)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(best.t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN n USING (conv_id) LEFT JOIN z USING (conv_id)"""

"""Operator 12: conversation structure repair over a suffix-shared automaton.

A conversation's rows are read by turn (null turns first; rows of one turn by
role, then by the SHA-256 of role and text).  The first fault of a row counts:
blank (nothing but white space), duplicate (role and text seen earlier in the
conversation) or truncated (the last character that is not white space is none
of ``.!?``).  The cheapest edits that make the role initials match
``(s?(ua)+)?`` are found and, among equally cheap ones, those whose initials
are ASCII-least: Keep 0, Rerole to user or assistant 3, Delete 4 (blank and
duplicate rows must go), Insert an empty user or assistant turn 3; a truncated
row that stays costs 3 more.

What decides the edits is one symbol a row, its role and fault.  The symbols
of a conversation are its signature; equal signatures are solved once.  The
different ones are sorted by their reversed text and range-partitioned, so
those with a common end meet; the automaton of each range is built from the
end, a signature shares the nodes of the end it has in common with the one
before, and only nodes that no later signature can share are let go.  A node
holds the cost-to-go and the best edit for each of the four states of the
grammar.  All choices at a node differ in their first letter, so the cheapest
one with the least letter begins the least audit.  Nodes whose costs-to-go
differ by a constant are one class, and the edits of a class and symbol are
worked out once.

Hot conversations: a row's fault is settled by the first turn that has its
text (partial minimum, joined back), rows are range-partitioned inside
conversations, and each run of rows in a batch becomes one piece of a
signature, one byte a row.  Only the last step reads a conversation in one
task, since a digest or a text in order is sequential by nature; it streams
rows sorted by Spark and holds one of them at a time.

Defined results: null roles and texts are one space (blank rows).  A null
conv_id is a conversation of its own; null turns come first and count in no
gap.  An empty role has no legal initial.  Repeated rows are duplicates.
Texts are read whole.  Other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, read

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
SPACES, BLANK = " \t\n\x0b\f\r", "[^\\x20\\x09-\\x0D]"
#: States of ``(s?(ua)+)?``: start, after s, after u, after a.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
#: The state an initial leads to, and the initial an added or reroled row takes.
STEP = [{"s": AFTER_S, "u": AFTER_U}, {"u": AFTER_U}, {"a": AFTER_A}, {"u": AFTER_U}]
NEEDED = ["u", "u", "a", "u"]
NAMES = {"u": "user", "a": "assistant"}
MUST_GO = "d"


# ------------------------------------------------------------ the automaton

class Grammar:
    """Classes of nodes: their four costs-to-go less the least of them."""

    def __init__(self):
        self.costs: list[tuple[int, ...]] = []
        self.known: dict[tuple[int, ...], int] = {}
        self.moves: dict[tuple[int, str], tuple[int, int, tuple]] = {}
        accept = (0, None, None, 0)
        self.end, _, self.last = self._closed(accept, [None] * 4)

    def _class(self, costs: tuple[int, ...]) -> tuple[int, int]:
        least = min(costs)
        rest = tuple(c - least for c in costs)
        if rest not in self.known:
            self.known[rest] = len(self.costs)
            self.costs.append(rest)
        return self.known[rest], least

    def _closed(self, own: tuple, edits: list) -> tuple[int, int, tuple]:
        """With insertions: (class, least cost, (letters, next state) per state).
        ``edits`` has (letter, next state) of the row itself, None at the end."""
        cost = [99 if c is None else c for c in own]
        best = list(edits)
        out = [None] * 4
        chosen = [None if c is None else "" if e is None else e[0] for c, e in zip(own, edits)]
        for _ in range(3):                       # at most three insertions help
            for q in range(4):
                to = STEP[q][NEEDED[q]]
                new = cost[to] + INSERT
                if chosen[to] is not None and (chosen[q] is None or (new, "I") < (cost[q], chosen[q][:1])):
                    cost[q], chosen[q], best[q] = new, "I" + chosen[to], best[to]
        for q in range(4):
            out[q] = (chosen[q], None if best[q] is None else best[q][1])
        number, least = self._class(tuple(cost))
        return number, least, tuple(out)

    def before(self, after: int, symbol: str) -> tuple[int, int, tuple]:
        """(class, cost added, edits per state) of a row in front of a class."""
        found = self.moves.get((after, symbol))
        if found is None:
            costs = self.costs[after]
            own, edits = [], []
            for q in range(4):
                ways = [(costs[q] + DELETE, "D", q)]
                if symbol != MUST_GO:
                    extra = TRUNCATED if symbol.isupper() else 0
                    kept = STEP[q].get(symbol.lower())
                    if kept is not None:
                        ways.append((costs[kept] + KEEP + extra, "K", kept))
                    to = STEP[q][NEEDED[q]]
                    ways.append((costs[to] + REROLE + extra, "R", to))
                cost, letter, to = min(ways)
                own.append(cost)
                edits.append((letter, to))
            found = self.moves[after, symbol] = self._closed(tuple(own), edits)
        return found


def solved(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Signatures sorted by their reversed text: (signature, cost, audit)."""
    grammar = Grammar()
    held = ""                                    # the reversed signature on the path
    nodes: list[tuple[int, int, tuple]] = [(grammar.end, 0, grammar.last)]
    for batch in it:
        cost, audit = [], []
        for signature in batch.column("signature").to_pylist():
            path = signature[::-1]
            same = common_start(held, path)
            del nodes[same + 1:]
            for symbol in path[same:]:
                after, total, _ = nodes[-1]
                number, added, edits = grammar.before(after, symbol)
                nodes.append((number, total + added, edits))
            held = path
            number, total, _ = nodes[-1]
            cost.append(total + grammar.costs[number][START])
            letters, state = [], START
            for at in range(len(path), -1, -1):
                own, state = nodes[at][2][state]
                letters.append(own)
            audit.append("".join(letters))
        yield pa.RecordBatch.from_arrays([batch.column("signature"), pa.array(cost, pa.int64()), pa.array(audit, pa.string())],
                                         names=["signature", "cost", "audit"])


def common_start(a: str, b: str) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


# ------------------------------------------------------------- signatures

def keyed(rows: DataFrame) -> DataFrame:
    """(key, conv_id, turn, role, text, digest): ``key`` is never null."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    return rows.select(F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("key"),
                       "conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
                       F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"))


def faults(rows: DataFrame) -> DataFrame:
    """(key, conv_id, turn, role, digest, initial, blank, cut, again, n): one
    row per different row; ``again`` if an earlier turn has it."""
    last = F.substring(F.rtrim(F.col("text"), F.lit(SPACES)), -1, 1)
    initial = F.substring("role", 1, 1)
    once = (rows.select("key", "conv_id", "turn", "role", "digest",
                        F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"),
                        (~F.col("text").rlike(BLANK)).alias("blank"), (~last.isin(".", "!", "?")).alias("cut"))
            .groupBy("key", "conv_id", "turn", "role", "digest", "initial", "blank", "cut").agg(F.count("*").alias("n")))
    once = materialize(once, "turns")
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = once.groupBy("key", "digest").agg(F.min(place).alias("first"))
    return once.join(first, ["key", "digest"]).withColumn("again", place > F.col("first")).drop("first")


SEGMENT = pa.schema([("key", pa.string()), ("conv_id", pa.int64()), ("part", pa.int64()), ("seq", pa.int64()),
                     ("symbols", pa.string()), ("first_initial", pa.string()), ("last_initial", pa.string()),
                     ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("low", pa.int64()), ("turns", pa.int64()),
                     ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64())])
SEGMENT_DDL = ("key string, conv_id {id}, part long, seq long, symbols string, first_initial string, last_initial string, "
               "first_turn long, last_turn long, low long, turns long, blank long, duplicate long, truncated long, illegal long")
LEGAL = {"su", "ua", "au"}


def segments(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows to one row per run of a conversation in a batch."""
    part, seq = TaskContext.get().partitionId(), 0
    for batch in it:
        out: list[dict] = []
        rows = zip(*(batch.column(c).to_pylist() for c in (
            "key", "conv_id", "turn", "initial", "blank", "cut", "again", "n")))
        for key, conv, turn, initial, blank, cut, again, n in rows:
            if not out or out[-1]["key"] != key:
                seq += 1
                out.append({"key": key, "conv_id": conv, "part": part, "seq": seq, "symbols": [],
                            "first_initial": initial, "last_initial": None, "first_turn": turn, "last_turn": None, "low": None,
                            "turns": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0})
            own = out[-1]
            if own["low"] is None:
                own["low"] = turn
            if turn is not None and (not own["symbols"] or own["last_turn"] != turn):
                own["turns"] += 1
            if own["symbols"] and own["last_initial"] + initial not in LEGAL:
                own["illegal"] += 1
            own["illegal"] += n - 1
            own["last_initial"], own["last_turn"] = initial, turn
            if blank:
                own["blank"] += n
            elif again:
                own["duplicate"] += n
            else:
                own["truncated"] += cut
                own["duplicate"] += n - 1
                own["symbols"].append(initial.upper() if cut else initial)
                n -= 1
            own["symbols"].append(MUST_GO * n)
        for own in out:
            own["symbols"] = "".join(own["symbols"])
        yield pa.RecordBatch.from_arrays(
            [pa.array([o[f.name] for o in out], type=batch.schema.field("conv_id").type if f.name == "conv_id" else f.type)
             for f in SEGMENT], names=SEGMENT.names)


def signatures(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``keyed`` rows: its signature and counts."""
    found = materialize(faults(rows), "faults")
    order = ("key", "turn", "role", "digest")
    pieces = found.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        segments, SEGMENT_DDL.format(id=found.schema["conv_id"].dataType.simpleString()))
    sums = [F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "turns")]
    pieces = pieces.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), *sums, F.min("low").alias("low"), F.max("last_turn").alias("high"),
        F.sort_array(F.collect_list(F.struct("part", "seq", "symbols", "first_initial", "last_initial",
                                             "first_turn", "last_turn"))).alias("p"))
    borders = F.zip_with(F.slice("p", 1, F.size("p") - 1), F.slice("p", 2, F.size("p")), lambda a, b: F.struct(
        (~F.concat(a["last_initial"], b["first_initial"]).isin(*LEGAL)).alias("illegal"),
        F.coalesce(a["last_turn"] == b["first_turn"], F.lit(False)).alias("same")))
    return pieces.withColumn("borders", borders).select(
        "key", "conv_id", F.array_join(F.transform("p", lambda x: x["symbols"]), "").alias("signature"),
        F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns")
                   + F.size(F.filter("borders", lambda x: x["same"])), F.lit(0)).cast("long").alias("gaps"),
        "blank", "duplicate", "truncated",
        (F.col("illegal") + F.size(F.filter("borders", lambda x: x["illegal"]))).alias("illegal"))


def audits(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``keyed`` rows: key, conv_id, the counts,
    cost and audit."""
    own = materialize(signatures(rows), "signatures")
    back = F.reverse("signature")
    best = (own.select("signature").distinct().repartitionByRange(back).sortWithinPartitions(back)
            .mapInArrow(solved, "signature string, cost long, audit string"))
    return own.join(best, "signature").drop("signature")


# ------------------------------------------------------------------ repair

HEAD = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


class Repaired:
    """The edits of one conversation, applied as its rows pass by."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def _added(self, edit: str, text: str) -> tuple[str, str, str]:
        initial = NEEDED[self.state]
        self.state = STEP[self.state][initial]
        return edit, NAMES[initial], text

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self._added("I", "")

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = STEP[self.state][role[0]]
            yield edit, role, text
        elif edit == "R":
            yield self._added("R", text)


def with_audits(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows by conversation, in order, each conversation's audit before them."""
    head = found.select("key", F.lit(0).alias("row"), F.lit(None).cast("long").alias("turn"),
                        F.lit(None).cast("string").alias("role"), F.lit(None).cast("binary").alias("digest"),
                        F.lit(None).cast("string").alias("text"), F.struct(*HEAD).alias("head"))
    body = rows.select("key", F.lit(1).alias("row"), "turn", "role", "digest", "text",
                       F.lit(None).cast(head.schema["head"].dataType).alias("head"))
    order = ("key", "row", "turn", "role", "digest")
    return head.unionByName(body).repartition("key").sortWithinPartitions(*order).select("head", "role", "text")


def conversations(it: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Iterator | None]]:
    """Per head (head, None), then per row the edited rows it gives, at the
    end of a conversation what is inserted after its last row."""
    own, head = None, None
    for batch in it:
        for new, role, text in zip(*(batch.column(c).to_pylist() for c in ("head", "role", "text"))):
            if new is not None:
                if own is not None:
                    yield head, own.inserted()
                own, head = Repaired(new["audit"]), new
                yield head, None
            else:
                yield head, own.row(role, text)
    if own is not None:
        yield head, own.inserted()


def digests(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    done: list[dict] = []
    sha, first = None, True

    def flush(ready: list[dict]) -> pa.RecordBatch:
        names = [*HEAD, "repaired_sha256"]
        return pa.RecordBatch.from_pydict({n: [r[n] for r in ready] for n in names})

    for head, rows in conversations(it):
        if rows is None:
            if done:
                done[-1]["repaired_sha256"] = sha.hexdigest()
            if len(done) >= 2_000:
                yield flush(done)
                done = []
            done.append(dict(head))
            sha, first = hashlib.sha256(), True
            continue
        for _, role, text in rows:
            sha.update(f"{'' if first else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
            first = False
    if done:
        done[-1]["repaired_sha256"] = sha.hexdigest()
        yield flush(done)


def turns(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: dict[str, list] = {n: [] for n in ("conv_id", "position", "role", "text", "edit")}
    position = 0
    for head, rows in conversations(it):
        if rows is None:
            position = 0
            continue
        for edit, role, text in rows:
            for name, value in zip(out, (head["conv_id"], position, role, text, edit)):
                out[name].append(value)
            position += 1
        if len(out["text"]) >= 1_000:
            yield pa.RecordBatch.from_pydict(out)
            out = {n: [] for n in out}
    if out["text"]:
        yield pa.RecordBatch.from_pydict(out)


def repair(rows: DataFrame) -> DataFrame:
    """The repaired conversations of ``rows`` (conv_id, turn, role, text):
    (conv_id, position, role, text, edit), edit being K, R or I."""
    base = keyed(rows)
    kind = rows.schema["conv_id"].dataType.simpleString()
    return with_audits(base, audits(base)).mapInArrow(
        turns, f"conv_id {kind}, position long, role string, text string, edit string")


def repaired_digests(rows: DataFrame) -> DataFrame:
    """One row per conversation: its counts, cost, audit, and the SHA-256 of
    its repaired ``role:text`` lines."""
    base = keyed(rows)
    kind = rows.schema["conv_id"].dataType.simpleString()
    counts = ", ".join(f"{c} long" for c in HEAD[1:-1])
    return with_audits(base, audits(base)).mapInArrow(
        digests, f"conv_id {kind}, {counts}, audit string, repaired_sha256 string")


# ------------------------------------------------------------------- query

def damaged(rows: DataFrame) -> DataFrame:
    """The contract's damage, by the CRC-32 of ``conv_id:turn``."""
    spaced = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fault = F.crc32(F.concat_ws(":", *spaced)) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    copies = F.array_repeat(F.lit(0), F.when(fault == 3, 2).otherwise(1))
    return (rows.withColumn("fault", fault).filter("fault <> 0").select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(copies).alias("copy")).drop("copy"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = repaired_digests(damaged(rows)).withColumnRenamed("conv_id", "own")
    ids = rows.select("conv_id").distinct()
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in HEAD[1:-1]]
    return ids.join(found, F.col("conv_id").eqNullSafe(F.col("own")), "left").select(
        "conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))

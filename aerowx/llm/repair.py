"""Cheapest repair of conversations whose turns are blank, repeated, cut off or out of order.

The ways to edit the first i turns of a conversation and to stand in one of four states (nothing
said, system said, user said, assistant said) are the nodes of a lattice; keeping, giving another
role, deleting and inserting are its arcs. Bidirectional Dijkstra searches it from both ends: the
heaps go on until no crossing as cheap as the best can be left, and of the crossings the least
audit is taken. An audit to a node is compared as text; of equal cost and equal turns none can be the
beginning of another, so the least beginning and the least end make the least whole.

Equal turns are counted before the shuffle. Turns are then sorted by conversation over ranges, and a
conversation that lies inside one range and is not long is repaired where it stands. One that
meets a border of its range, or has more than ``SEGMENT`` turns, goes on as segments: each is searched
between every pair of states, a conversation's segments are put together in order, and the
repaired text is built segment by segment and digested in order. No task holds a long conversation's
texts; its audit is one value of the result and is held by one task.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from os.path import commonprefix

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import written

SEGMENT = 512
SEGMENT_CHARS = 2 << 20
SPACE = " \t\n\v\f\r"
RIGHT_ENDS = (".", "!", "?")
LEGAL = {"su", "ua", "au"}
#: Costs (fixed values).
REROLE, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5
#: States, and where the next turn leads: kept, by its initial, or as user or assistant.
START, SYSTEM, USER, ASSISTANT = STATES = range(4)
KEEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
DONE = (START, ASSISTANT)


def _after(steps, node):
    """Arcs out of a node: cost, letters, next node."""
    i, state = node
    if i < len(steps):
        initial, bad, cut_off, times = steps[i]
        yield DELETE * times, "D" * times, (i + 1, state)
        if not bad:
            kept = KEEP.get((state, initial))
            if kept is not None:
                yield CUT_OFF * cut_off, "K", (i + 1, kept)
            if NEXT[state] != kept:
                yield REROLE + CUT_OFF * cut_off, "R", (i + 1, NEXT[state])
    yield INSERT, "I", (i, NEXT[state])


def _before(steps, node):
    """Arcs into a node: cost, letters, node they come from."""
    i, state = node
    if i:
        initial, bad, cut_off, times = steps[i - 1]
        yield DELETE * times, "D" * times, (i - 1, state)
        if not bad:
            for s in STATES:
                if KEEP.get((s, initial)) == state:
                    yield CUT_OFF * cut_off, "K", (i - 1, s)
                elif NEXT[s] == state:
                    yield REROLE + CUT_OFF * cut_off, "R", (i - 1, s)
    for s in STATES:
        if NEXT[s] == state:
            yield INSERT, "I", (i, s)


def cheapest(steps, entry: int = START, exits=DONE) -> tuple[int, str] | None:
    """Cost and audit of the cheapest way through ``steps``, of equal cost the least audit.

    A step is (initial, must be deleted, cut off, how often); only steps that must be deleted
    stand more than once. None if no way leads to an exit.
    """
    n = len(steps)
    forth, back = {(0, entry): (0, "")}, {(n, x): (0, "") for x in exits}
    heaps = [(0, 0, entry)], [(0, 0, x) for x in exits]
    heapq.heapify(heaps[1])
    settled: tuple[set, set] = set(), set()
    best = None
    # Arcs without cost use up a turn, so among equal costs nodes settle in the order of turns.
    while heaps[0] and heaps[1] and (best is None or heaps[0][0][0] + heaps[1][0][0] <= best[0]):
        reverse = heaps[1][0][0] < heaps[0][0][0]
        cost, turns, state = heapq.heappop(heaps[reverse])
        node = (n - turns if reverse else turns, state)
        if node in settled[reverse]:
            continue
        settled[reverse].add(node)
        labels, others = (back, forth) if reverse else (forth, back)
        audit = labels[node][1]
        crossings = [(cost, audit, node)]
        for more, letters, to in (_before if reverse else _after)(steps, node):
            label = (cost + more, letters + audit if reverse else audit + letters)
            crossings.append((*label, to))
            if to not in settled[reverse] and (to not in labels or label < labels[to]):
                labels[to] = label
                heapq.heappush(heaps[reverse], (label[0], n - to[0] if reverse else to[0], to[1]))
        for total, letters, at in crossings:
            if at in settled[not reverse]:
                rest = others[at]
                whole = (total + rest[0], rest[1] + letters if reverse else letters + rest[1])
                if best is None or whole < best:
                    best = whole
    return best


def _summary(rows: list[dict]) -> dict:
    """Faults and lattice steps of consecutive turns; ``lead`` says that none equal came before."""
    out = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "turns": 0, "low": None, "high": None}
    out |= {"first": None, "last": None, "steps": []}
    for row in rows:
        copies, initial = row["copies"], row["role"][:1]
        if not copies:
            continue
        said = row["text"].strip(SPACE)
        if not said:
            out["blank"] += copies
            out["steps"].append((initial, True, False, copies))
        else:
            cut_off = said[-1] not in RIGHT_ENDS
            if row["lead"]:
                out["truncated"] += cut_off
                out["steps"].append((initial, False, cut_off, 1))
            if again := copies - bool(row["lead"]):
                out["duplicate"] += again
                out["steps"].append((initial, True, False, again))
        # A role never follows itself.
        out["illegal"] += copies - 1 + (out["last"] is not None and out["last"] + initial not in LEGAL)
        out["first"] = initial if out["first"] is None else out["first"]
        out["last"] = initial
        if row["known"]:
            out["turns"] += out["high"] != row["turn"]
            out["low"] = row["turn"] if out["low"] is None else out["low"]
            out["high"] = row["turn"]
    return out


def _result(key: str, found: dict, cost: int, audit: str) -> dict:
    gaps = 0 if found["low"] is None else found["high"] - found["low"] + 1 - found["turns"]
    counts = {c: int(found[c]) for c in ("blank", "duplicate", "truncated", "illegal")}
    return {"key": key, "gaps": gaps, **counts, "cost": cost, "audit": audit}


def _edited(rows: list[dict], audit: str, state: int) -> list[str]:
    """``role:text`` of the turns that an audit leaves."""
    turns = []
    for row in rows:
        turns += [row] * row["copies"]
    out, at = [], 0
    for letter in audit:
        if letter == "I":
            state = NEXT[state]
            out.append(f"{ROLE[state]}:")
            continue
        row, at = turns[at], at + 1
        if letter == "K":
            state = KEEP[state, row["role"][:1]]
            out.append(f"{row['role']}:{row['text']}")
        elif letter == "R":
            state = NEXT[state]
            out.append(f"{ROLE[state]}:{row['text']}")
    return out


def _sha(lines: list[str]) -> str:
    return hashlib.sha256("\n".join(lines).encode("utf-8", "surrogatepass")).hexdigest()


TURN = pa.schema([("known", pa.bool_()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("copies", pa.int64())])
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
RESULT = pa.schema([("key", pa.string()), *[(c, pa.int64()) for c in COUNTS], ("audit", pa.string()), ("repaired_sha256", pa.string())])
SCANNED = pa.schema([*RESULT, ("range", pa.int64()), ("segment", pa.int64()), ("place", pa.int64()), *TURN])
_SQL = {pa.int64(): "long", pa.string(): "string", pa.bool_(): "boolean"}


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"`{f.name}` {_SQL[f.type]}" for f in schema)


def _whole(key: str, rows: list[dict]) -> dict:
    """The result of a conversation that is all here."""
    seen = set()
    for row in rows:
        pair = (row["role"], row["text"])
        row["lead"] = bool(row["copies"]) and pair not in seen
        if row["copies"]:
            seen.add(pair)
    found = _summary(rows)
    cost, audit = cheapest(found["steps"])
    return _result(key, found, cost, audit) | {"repaired_sha256": _sha(_edited(rows, audit, START))}


def _scan(segment: int, segment_chars: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = TaskContext.get().partitionId()
        out: list[dict] = []
        key, held, chars, number, inside = None, [], 0, 0, False

        def apart() -> None:
            out.extend({**r, "range": here, "segment": number, "place": k} for k, r in enumerate(held))

        for batch in batches:
            for row in batch.to_pylist():
                if row["key"] != key:
                    if key is not None:
                        # The first conversation of a range may have begun in the one before.
                        out.append(_whole(key, held)) if inside and not number else apart()
                    key, held, chars, number, inside = row["key"], [], 0, 0, key is not None
                elif len(held) >= segment or chars >= segment_chars:
                    apart()
                    held, chars, number = [], 0, number + 1
                held.append(row)
                chars += len(row["text"])
            yield pa.RecordBatch.from_pylist(out, SCANNED)
            out.clear()
        apart()
        yield pa.RecordBatch.from_pylist(out, SCANNED)

    return scan


def _between(key, frame: pd.DataFrame) -> pd.DataFrame:
    """Faults of a segment and its cheapest way between every two states, as JSON."""
    rows = frame.sort_values("place").to_dict("records")
    found = _summary(rows)
    steps = found.pop("steps")
    found["ways"] = [(s, t, *way) for s in STATES for t in STATES if (way := cheapest(steps, s, (t,)))]
    text = json.dumps(found, default=int)
    return pd.DataFrame({"key": [key[0]], "range": [key[1]], "segment": [key[2]], "found": [text]})


PATH = pa.schema([*RESULT, ("range", pa.int64()), ("segment", pa.int64()), ("enter", pa.int64()), ("leave", pa.int64())])


def _joined(key: str, segments: Iterator[tuple[int, int, dict]]) -> Iterator[dict]:
    """A conversation from its segments in order: its result, and the states between segments."""
    total = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "turns": 0, "low": None, "high": None, "last": None}
    front, agreed, places, came = {START: (0, "")}, [], [], []
    for place, number, found in segments:
        for c in ("blank", "duplicate", "truncated"):
            total[c] += found[c]
        if found["first"] is not None:
            meet = total["last"] is not None and total["last"] + found["first"] not in LEGAL
            total["illegal"] += found["illegal"] + meet
            total["last"] = found["last"]
        if found["low"] is not None:
            total["turns"] += found["turns"] - (total["high"] == found["low"])
            total["low"] = found["low"] if total["low"] is None else total["low"]
            total["high"] = found["high"]
        reached: dict = {}
        for s, t, cost, audit in found["ways"]:
            if s in front:
                label = (front[s][0] + cost, front[s][1] + audit, s)
                if t not in reached or label < reached[t]:
                    reached[t] = label
        same = commonprefix([x[1] for x in reached.values()])
        agreed.append(same)
        front = {t: (cost, audit[len(same) :]) for t, (cost, audit, _) in reached.items()}
        places.append((place, number))
        came.append({t: x[2] for t, x in reached.items()})
    cost, rest, state = min((*front[t], t) for t in DONE if t in front)
    yield _result(key, total, cost, "".join(agreed) + rest)
    for (place, number), back in zip(reversed(places), reversed(came)):
        yield {"key": key, "range": place, "segment": number, "enter": back[state], "leave": state}
        state = back[state]


def _join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            yield from batch.to_pylist()

    stream = rows()
    row = next(stream, None)
    while row is not None:
        key, after = row["key"], []

        def segments(row=row):
            while row is not None and row["key"] == key:
                yield row["range"], row["segment"], json.loads(row["found"])
                row = next(stream, None)
            after.append(row)

        yield pa.RecordBatch.from_pylist(list(_joined(key, segments())), PATH)
        row = after[0]


def _lines(key, frame: pd.DataFrame, path: pd.DataFrame) -> pd.DataFrame:
    """What a segment leaves, as text; NULL if nothing."""
    rows = frame.sort_values("place").to_dict("records")
    enter, leave = int(path["enter"].iloc[0]), int(path["leave"].iloc[0])
    _, audit = cheapest(_summary(rows)["steps"], enter, (leave,))
    left = _edited(rows, audit, enter)
    return pd.DataFrame(
        {"key": [key[0]], "range": [key[1]], "segment": [key[2]], "lines": ["\n".join(left) if left else None]}
    )


def _digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    key, sha, begun = None, None, False
    for batch in batches:
        out = []
        for k, lines in zip(batch["key"], batch["lines"]):
            if k != key:
                if key is not None:
                    out.append((key, sha.hexdigest()))
                key, sha, begun = k, hashlib.sha256(), False
            if lines is not None:
                sha.update((("\n" if begun else "") + lines).encode("utf-8", "surrogatepass"))
                begun = True
        yield pd.DataFrame(out, columns=["key", "sha"])
    if key is not None:
        yield pd.DataFrame([(key, sha.hexdigest())], columns=["key", "sha"])


def _apart(rows: DataFrame) -> DataFrame:
    """Results of conversations that lie in several segments."""
    same = ["key", "role", "text"]
    lead = F.min(F.struct("range", "segment", "place")).alias("first")
    firsts = rows.where("copies > 0").groupBy(*same).agg(lead)
    rows = rows.join(firsts, same, "left").withColumn(
        "lead", F.coalesce(F.col("first") == F.struct("range", "segment", "place"), F.lit(False))
    )
    rows = written(rows.drop("first"), "segments")
    place = ["key", "range", "segment"]
    found = rows.groupBy(*place).applyInPandas(_between, "key string, range long, segment long, found string")
    path = written(
        found.repartition("key").sortWithinPartitions(*place).mapInArrow(_join, _ddl(PATH)), "segment-paths"
    )
    steps = path.where("enter IS NOT NULL").select(*place, "enter", "leave")
    lines = (
        rows.groupBy(*place).cogroup(steps.groupBy(*place)).applyInPandas(_lines, "key string, range long, segment long, lines string")
    )
    digests = lines.repartition("key").sortWithinPartitions(*place).mapInPandas(_digest, "key string, sha string")
    results = path.where("enter IS NULL").select("key", *COUNTS, "audit")
    return results.join(digests, "key").withColumnRenamed("sha", "repaired_sha256")


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns damaged by crc32 of ``conv_id:turn``, modulo 20; columns conv_id, turn, role, text, copies.

    0 drops a turn (no copies), 1 empties its text, 2 takes out ``.!?``, 3 repeats it (two copies),
    4 gives it to the user. A NULL in the key, a role or a text counts as one space.
    """

    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat_ws(":", spaced("conv_id"), spaced("turn")).cast("binary")) % 20
    gone = kind == 0
    text = F.when(gone | (kind == 1), "").when(kind == 2, F.regexp_replace(spaced("text"), "[.!?]", "")).otherwise(spaced("text"))
    role = F.when(gone, "").when(kind == 4, "user").otherwise(spaced("role"))
    copies = F.when(gone, 0).when(kind == 3, 2).otherwise(1)
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.cast("long").alias("copies"))


def repair(turns: DataFrame, segment: int = SEGMENT, segment_chars: int = SEGMENT_CHARS) -> DataFrame:
    """The cheapest repair of each conversation of (conv_id, turn, role, text[, copies]).

    Turns stand in the order of ``turn``, NULL first, of equal ones by role and text. The first of
    these faults counts: blank (only white space), duplicate (role and text seen earlier),
    truncated (the last other character is none of ``.!?``). What is left must have the initials
    ``(s?(ua)+)?``. Keeping costs 0, another role 1, deleting 2 (blank and duplicate turns must go),
    inserting an empty turn 5; a truncated turn that stays adds 5.

    Returns (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) per
    conv_id, NULL included: numbers missing between the least and the largest turn, the faults,
    neighbours whose initials are none of su, ua, au, the cost, the initials of the edits (K, R, D, I),
    the least in ASCII of the cheapest ones, and the digest of the repaired ``role:text`` lines. A NULL
    role or text is one space; a turn without ``copies`` stands once, one of no copies not at all, and a
    conversation of such turns has zeros and an empty audit. Repeated rows are duplicates. Other
    columns are ignored; an empty table gives an empty result.
    """
    kind = dict(turns.dtypes)["conv_id"]
    copies = F.col("copies") if "copies" in turns.columns else F.lit(1)
    rows = turns.select(
        # Never NULL, so that no conversation's key is like another's.
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("key"),
        F.col("turn").isNotNull().alias("known"),
        F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
        F.coalesce(F.col("role"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text"), F.lit(" ")).alias("text"),
        copies.cast("long").alias("copies"),
    )
    order = ["key", "known", "turn", "role", "text"]
    counted = rows.groupBy(*order).agg(F.sum("copies").alias("copies"))
    ranges = counted.repartitionByRange(*order).sortWithinPartitions(*order)
    scanned = written(ranges.mapInArrow(_scan(segment, segment_chars), _ddl(SCANNED)), "conversations")
    done = scanned.where("segment IS NULL").select(*RESULT.names)
    apart = _apart(scanned.where("segment IS NOT NULL").select("key", "range", "segment", "place", *TURN.names))
    conv_id = F.when(F.col("key") != "", F.col("key").substr(F.lit(2), F.length("key"))).cast(kind).alias("conv_id")
    return done.unionByName(apart.select(*RESULT.names)).select(conv_id, *COUNTS[:-1], "cost", "audit", "repaired_sha256")

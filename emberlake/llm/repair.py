"""Conversation structure repair by a bidirectional Dijkstra search.

A conversation is a row of turns; a sound one has the role initials
``(s?(ua)+)?``: perhaps a system turn, then user and assistant in turn.  The
edit lattice has a node for each turn boundary and grammar state, and an edge
for each edit: Keep costs 0, Rerole (to user or assistant) 1, Delete 2, Insert
(an empty turn) 5; an undeleted truncated turn adds 5; blank and repeated turns
must go.  Two searches with a heap each, forward from the start and in reverse from the
end, meet in the middle and go on until no crossing of the best cost can be left; of
all the cheapest edits the least audit (the edits' initials) is then read off
edge by edge over both halves.

``damage`` first breaks conversations in known ways, for the report.

Scale: rows are put in order by range partitioning (``ordered.running``), so a
conversation of any length is spread over tasks; a turn becomes one letter
for its role's initial and fault, and only these letters, in segments of
``SEGMENT`` turns, reach the search.  A longer conversation is searched segment by
segment between all pairs of states, and the segments' tables are joined, which
gives the same answer, as no audit over the same turns begins another of equal
cost.  Texts are streamed, turn by turn and in order, through the digest.

Cases: nulls in any column are written as one space, so a null text is blank
and a null role has no legal initial; a null conversation id is one
conversation; a null turn number comes first, and turns of one number are
ordered by role and the digest of the text; a conversation without rows after
damage has zeros, an empty audit and the empty digest; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlake.llm.common import SPACE_CLASS, crc32_sql, staged, with_code
from emberlake.llm.ordered import running

SEGMENT = 4096
RUN = 1 << 16  # a longer conversation is searched in stretches of this many turns
FATES = 20
DROPPED, EMPTIED, UNSTOPPED, REPEATED, REROLED = range(5)

# Grammar states: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
FINAL = (START, ASSISTANT)
ONWARD = (USER, USER, ASSISTANT, USER)  # the state after the next user or assistant turn
KINDS = "sua"  # other initials are of no kind
BY_KIND = {0: {START: SYSTEM}, 1: {START: USER, SYSTEM: USER, ASSISTANT: USER}, 2: {USER: ASSISTANT}, 3: {}}
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
REROLE, DELETE, INSERT, UNFINISHED = 1, 2, 5, 5
FIRST_CODE = ord("A")


def _code(kind: int, fault: int) -> int:
    return FIRST_CODE + 4 * kind + fault


def _row_edges(code: int) -> list[tuple[int, int, int, str]]:
    """(state, next state, cost, edit) of one turn."""
    kind, fault = divmod(code - FIRST_CODE, 4)
    edges = [(s, s, DELETE, "D") for s in range(4)]
    if fault not in (BLANK, DUPLICATE):
        more = UNFINISHED if fault == TRUNCATED else 0
        edges += [(s, t, more, "K") for s, t in BY_KIND[kind].items()]
        edges += [(s, ONWARD[s], REROLE + more, "R") for s in range(4)]
    return edges


_OUT: dict[int, list[list[tuple[int, int, str]]]] = {}
_IN: dict[int, list[list[tuple[int, int, str]]]] = {}
for _c in (_code(k, f) for k in range(4) for f in range(4)):
    _OUT[_c], _IN[_c] = [[] for _ in range(4)], [[] for _ in range(4)]
    for _s, _t, _w, _e in _row_edges(_c):
        _OUT[_c][_s].append((_t, _w, _e))
        _IN[_c][_t].append((_s, _w, _e))


def _after(node: int, codes: bytes) -> Iterator[tuple[int, int, str]]:
    """Edges (node, cost, edit) out of ``node`` = 4 * boundary + state."""
    at, state = divmod(node, 4)
    yield 4 * at + ONWARD[state], INSERT, "I"
    if at < len(codes):
        for t, w, e in _OUT[codes[at]][state]:
            yield 4 * at + 4 + t, w, e


def _before(node: int, codes: bytes) -> Iterator[tuple[int, int, str]]:
    """Edges (node, cost, edit) into ``node``."""
    at, state = divmod(node, 4)
    for s in range(4):
        if ONWARD[s] == state:
            yield 4 * at + s, INSERT, "I"
    if at:
        for s, w, e in _IN[codes[at - 1]][state]:
            yield 4 * at - 4 + s, w, e


class _Search:
    """One of the two searches."""

    def __init__(self, sources: Iterable[int], edges, codes: bytes):
        self.cost = {s: 0 for s in sources}
        self.heap = [(0, s) for s in sorted(self.cost)]
        self.settled: set[int] = set()
        self.edges, self.codes = edges, codes

    def least(self) -> float:
        while self.heap and self.heap[0][1] in self.settled:
            heappop(self.heap)
        return self.heap[0][0] if self.heap else float("inf")

    def settle(self, other: "_Search") -> float:
        """Settle the nearest node; returns the cheapest meeting it makes."""
        cost, node = heappop(self.heap)
        self.settled.add(node)
        met = cost + other.cost.get(node, float("inf"))
        for to, w, _ in self.edges(node, self.codes):
            new = cost + w
            if new < self.cost.get(to, float("inf")):
                self.cost[to] = new
                heappush(self.heap, (new, to))
                met = min(met, new + other.cost.get(to, float("inf")))
        return met


def cheapest_edits(codes: bytes, entry: int = START, exits: Iterable[int] = FINAL) -> tuple[int, str] | None:
    """Least cost and least audit from state ``entry`` before the first turn
    to one of ``exits`` after the last, or None if there is no way."""
    goals = [4 * len(codes) + s for s in exits]
    ahead, back = _Search([entry], _after, codes), _Search(goals, _before, codes)
    best = 0 if entry in goals else float("inf")
    while not back.settled.issuperset(goals) and back.least() == 0:
        best = min(best, back.settle(ahead))
    # Below or at the best cost there may be another crossing: finish them all.
    while (near := ahead.least()) + (far := back.least()) <= best and near + far < float("inf"):
        best = min(best, ahead.settle(back) if near <= far else back.settle(ahead))
    if best == float("inf"):
        return None
    # Edges of cheapest ways: tight ones of either half, and those that cross over.
    crossing: dict[int, list[tuple[str, int]]] = {}
    within: dict[int, list[tuple[str, int]]] = {}
    into: dict[int, list[int]] = {}
    for u in ahead.settled:
        for v, w, e in _after(u, codes):
            if v in back.settled and ahead.cost[u] + w + back.cost[v] == best:
                crossing.setdefault(u, []).append((e, v))
            if v in ahead.settled and ahead.cost[u] + w == ahead.cost[v]:
                within.setdefault(u, []).append((e, v))
                into.setdefault(v, []).append(u)
    useful, todo = set(crossing), list(crossing)
    while todo:
        for u in into.get(todo.pop(), ()):
            if u not in useful:
                useful.add(u)
                todo.append(u)
    audit: list[str] = []
    front = {entry} & useful
    behind = {entry} & back.settled if back.cost.get(entry) == best else set()
    while behind.isdisjoint(goals):
        steps: list[tuple[str, bool, int]] = []
        for u in front:
            steps += [(e, True, v) for e, v in within.get(u, ()) if v in useful]
            steps += [(e, False, v) for e, v in crossing.get(u, ())]
        for u in behind:
            steps += [(e, False, v) for v, w, e in _after(u, codes)
                      if v in back.settled and back.cost[v] + w == back.cost[u]]
        least = min(e for e, *_ in steps)
        audit.append(least)
        front = {v for e, half, v in steps if e == least and half}
        behind = {v for e, half, v in steps if e == least and not half}
    return int(best), "".join(audit)


def repair_edits(codes: bytes, run: int = RUN) -> tuple[int, str]:
    """Least cost and audit of a whole conversation."""
    if len(codes) <= run:
        return cheapest_edits(codes)
    reach: dict[int, tuple[int, str]] = {START: (0, "")}
    for at in range(0, len(codes), run):
        part, ahead = codes[at:at + run], {}
        for entry, (cost, audit) in reach.items():
            for state in range(4):
                more = cheapest_edits(part, entry, [state])
                if more is not None:
                    way = (cost + more[0], audit + more[1])
                    ahead[state] = min(way, ahead.get(state, way))
        reach = ahead
    return min(reach[s] for s in FINAL if s in reach)


def row_acts(codes: bytes, audit: str) -> list[str]:
    """The edits at each turn with their roles: K, D, u and a (rerole), U and
    A (insert; before the turn's own edit, or after the last turn's)."""
    acts, held, state, at = [], "", START, 0
    for e in audit:
        user = ONWARD[state] == USER
        if e == "I":
            held, state = held + ("U" if user else "A"), ONWARD[state]
            continue
        kind = (codes[at] - FIRST_CODE) // 4
        at += 1
        if e == "K":
            state = BY_KIND[kind][state]
        elif e == "R":
            state, e = ONWARD[state], "u" if user else "a"
        acts.append(held + e)
        held = ""
    if held:
        acts[-1] += held
    return acts


def damage(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """(conv, turn, role, text): the rows, some of them dropped, emptied,
    without stops, repeated or given to the user, by a checksum of their place."""
    def spaced(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    place = F.concat(spaced(conv_col), F.lit(":"), spaced(turn_col))
    fate = F.crc32(place.cast("binary")) % FATES
    rows = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), fate.alias("fate"),
                        spaced(role_col).alias("role"), spaced(text_col).alias("text")).filter(F.col("fate") != DROPPED)
    text = (F.when(F.col("fate") == EMPTIED, "").when(F.col("fate") == UNSTOPPED, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text")))
    copies = F.when(F.col("fate") == REPEATED, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv", "turn", F.when(F.col("fate") == REROLED, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def ordered_turns(rows: DataFrame) -> DataFrame:
    """Add ``at``, the row's number in the order of (conv, turn, role, text),
    and the digest of role and text."""
    digest = F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"))
    keyed = staged(rows.withColumn("digest", digest), "repair-rows")
    order = [F.col("conv").isNull(), F.col("conv"), F.col("turn"), F.col("role"), F.col("digest")]
    return staged(running(keyed, order, {"at": F.lit(1)}, "repair-order"), "repair-turns")


def turn_codes(rows: DataFrame) -> DataFrame:
    """(conv, seg, first, codes): the turns' letters by segments of ``at``."""
    blank = ~F.col("text").rlike(f"[^{SPACE_CLASS}]")
    ended = F.col("text").rlike(rf"[.!?][{SPACE_CLASS}]*\z")
    initial = F.substring("role", 1, 1)
    kind = F.when(F.col("role") == "", len(KINDS))
    for i, k in enumerate(KINDS):
        kind = kind.when(initial == k, i)
    marks = rows.select("conv", "at", "digest", kind.otherwise(len(KINDS)).alias("kind"), blank.alias("blank"), ended.alias("ended"))
    news = rows.groupBy("conv", "digest").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("new"))
    fault = (F.when(F.col("blank"), BLANK).when(F.col("new").isNull(), DUPLICATE)
             .when(~F.col("ended"), TRUNCATED).otherwise(SOUND))
    coded = marks.join(news, "at", "left").select(
        "conv", "at", F.char(F.col("kind") * 4 + fault + FIRST_CODE).alias("code"))
    letters = F.transform(F.array_sort(F.collect_list(F.struct("at", "code"))), lambda x: x.code)  # at most SEGMENT
    return coded.groupBy("conv", F.floor(F.col("at") / SEGMENT).cast("long").alias("seg")).agg(
        F.min("at").alias("first"), F.array_join(letters, "").alias("codes"))


_LEGAL = {(0, 1), (1, 2), (2, 1)}


def _solved(run: int):
    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row for each segment with its acts; the first segment of a
        conversation has the conversation's figures as well."""
        kept: list[tuple] = []

        def flush() -> list[tuple]:
            codes = "".join(x[3] for x in kept).encode()
            cost, audit = repair_edits(codes, run)
            acts = row_acts(codes, audit)
            kind, fault = np.divmod(np.frombuffer(codes, dtype=np.uint8).astype(np.int64) - FIRST_CODE, 4)
            legal = sum(int(((kind[:-1] == a) & (kind[1:] == b)).sum()) for a, b in _LEGAL)
            figures = (*[int((fault == f).sum()) for f in (BLANK, DUPLICATE, TRUNCATED)], len(codes) - 1 - legal, cost, audit)
            out, at = [], 0
            for conv, _, first, part in kept:
                out.append((conv, first, acts[at:at + len(part)], *(figures if at == 0 else (None,) * 6)))
                at += len(part)
            return out

        for batch in batches:
            ready = []
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if kept and row[0] != kept[0][0]:
                    ready += flush()
                    kept.clear()
                kept.append(row)
            if ready:
                yield _as_batch(ready, batch.schema.field(0).type)
        if kept:
            yield _as_batch(flush(), batch.schema.field(0).type)
    return solve


FIGURES = ["blank", "duplicate", "truncated", "illegal", "cost"]


def _as_batch(rows: list[tuple], conv_type: pa.DataType) -> pa.RecordBatch:
    names = ["conv", "first", "acts", *FIGURES, "audit"]
    kinds = [conv_type, pa.int64(), pa.list_(pa.string()), *[pa.int64()] * len(FIGURES), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def solved(codes: DataFrame, run: int = RUN) -> DataFrame:
    """The cheapest edits of every conversation, a row for each segment."""
    with_code(codes.sparkSession)
    conv = codes.schema["conv"].dataType.simpleString()
    schema = f"conv {conv}, first long, acts array<string>, {', '.join(f'{f} long' for f in FIGURES)}, audit string"
    ordered = codes.repartition("conv").sortWithinPartitions("first")
    return ordered.select("conv", "seg", "first", "codes").mapInArrow(_solved(run), schema)


def repaired_turns(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """(conv, at, place, edit, role, text): the repaired turns; their order
    is that of (at, place)."""
    acts = edits.select("first", F.posexplode("acts").alias("i", "act")).select(
        (F.col("first") + F.col("i")).alias("at"), "act")
    each = rows.join(acts, "at").select("conv", "at", "role", "text", F.posexplode(F.split("act", "(?<=.)(?=.)")).alias("place", "edit"))
    upper = F.upper("edit")
    role = F.when(upper == "U", "user").when(upper == "A", "assistant").otherwise(F.col("role"))
    text = F.when(F.col("edit").isin("U", "A"), "").otherwise(F.col("text"))
    return each.filter("edit != 'D'").select("conv", "at", "place", "edit", role.alias("role"), text.alias("text"))


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's lines, one line in memory at a time."""
    started, conv, hasher, kind = False, None, None, None
    for batch in batches:
        kind, out = batch.schema.field(0).type, []
        for c, line in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if not started or c != conv:
                if started:
                    out.append((conv, hasher.hexdigest()))
                started, conv, hasher = True, c, hashlib.sha256()
            else:
                hasher.update(b"\n")
            hasher.update(line.as_buffer())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], kind), pa.array([r[1] for r in out])], names=["conv", "sha"])
    if started:
        yield pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([hasher.hexdigest()])], names=["conv", "sha"])


def repair_conversations(rows: DataFrame, run: int = RUN) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The ordered rows of a table (conv, turn, role, text), their cheapest
    edits and the repaired turns."""
    ordered = ordered_turns(rows)
    edits = staged(solved(turn_codes(ordered), run), "repair-edits")
    return ordered, edits, repaired_turns(ordered, edits)


def repair_report(turns: DataFrame, run: int = RUN) -> DataFrame:
    """One row per conversation of ``turns``, damaged and then repaired."""
    ordered, edits, repaired = repair_conversations(damage(turns), run)
    conv = ordered.schema["conv"].dataType.simpleString()
    lines = repaired.select("conv", "at", "place", F.concat("role", F.lit(":"), F.col("text")).alias("line"))
    lines = lines.repartition("conv").sortWithinPartitions("at", "place").select("conv", "line")
    shas = lines.mapInArrow(_digested, f"conv {conv}, sha string")
    wide = F.col("turn").cast("decimal(38,0)")
    span = F.max(wide) - F.min(wide) + 1 - F.countDistinct("turn")
    gaps = ordered.groupBy("conv").agg(F.least(F.coalesce(span, F.lit(0)), F.lit((1 << 63) - 1)).cast("long").alias("gaps"))
    parts = turns.select(F.col("conv_id").alias("conv")).distinct().unionByName(gaps, True).unionByName(
        edits.filter("audit IS NOT NULL").drop("acts", "first"), True).unionByName(shas, True)
    zero = F.lit(0).cast("long")
    return parts.groupBy("conv").agg(
        *[F.coalesce(F.max(c), zero).alias(c) for c in ["gaps", *FIGURES]],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("sha"), F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256")
    ).withColumnRenamed("conv", "conv_id")


def _oracle() -> str:
    """The same by a search from the last turn to the first: of each state
    the least cost and audit, as one text that sorts by both."""
    unreached = 10 ** 9

    def more(key: str, cost: str, edit: str) -> str:
        return f"lpad(CAST(CAST(left({key}, 10) AS BIGINT) + {cost} AS VARCHAR), 10, '0') || '{edit}' || substr({key}, 11)"

    onward = [f"v[{s + 1}]" for s in ONWARD]
    insert = "[" + ", ".join(f"least(v[{i + 1}], {more(o, str(INSERT), 'I')})" for i, o in enumerate(onward)) + "]"
    inserted = "list_transform(list_transform([{0}], lambda v: " + insert + "), lambda v: " + insert + ")[1]"
    extra = f"CASE WHEN fault = {TRUNCATED} THEN {UNFINISHED} ELSE 0 END"

    def row_step(state: int) -> str:
        kept = " ".join(f"WHEN x.kind = {k} THEN {more(f'v[{to[state] + 1}]', extra, 'K')}"
                        for k, to in BY_KIND.items() if state in to)
        best = [more(f"v[{state + 1}]", str(DELETE), "D"),
                f"CASE WHEN x.fault IN ({BLANK}, {DUPLICATE}) THEN 'x' ELSE {more(onward[state], f'{REROLE} + {extra}', 'R')} END",
                f"CASE WHEN x.fault IN ({BLANK}, {DUPLICATE}) THEN 'x' {kept} ELSE 'x' END"]
        return f"least({', '.join(best)})".replace("WHEN fault", "WHEN x.fault")

    step = "list_transform([v], lambda v: [" + ", ".join(map(row_step, range(4))) + "])[1]"
    zero, far = "lpad('0', 10, '0')", f"'{unreached:010d}'"
    final = "[" + ", ".join(zero if s in FINAL else far for s in range(4)) + "]"
    searched = inserted.format(step.replace("{", "{{").replace("}", "}}"))
    space = f"[{SPACE_CLASS}]"
    return f"""
WITH RECURSIVE fated AS (
  SELECT conv_id AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc32_sql("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % {FATES} AS fate
  FROM conversations
), damaged AS (
  SELECT conv, turn, CASE WHEN fate = {REROLED} THEN 'user' ELSE role END AS role,
    CASE WHEN fate = {EMPTIED} THEN '' WHEN fate = {UNSTOPPED} THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN fate = {REPEATED} THEN 2 ELSE 1 END)) AS copy
  FROM fated WHERE fate <> {DROPPED}
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, digest) AS i
  FROM (SELECT *, md5(strlen(role) || ':' || role || text) AS digest FROM damaged)
), marked AS (
  SELECT *, CASE left(role, 1) {' '.join(f"WHEN '{k}' THEN {n}" for n, k in enumerate(KINDS))} ELSE {len(KINDS)} END AS kind,
    CASE WHEN regexp_full_match(text, '{space}*') THEN {BLANK} WHEN i > min(i) OVER (PARTITION BY conv, digest) THEN {DUPLICATE}
      WHEN NOT regexp_matches(text, '[.!?]{space}*$') THEN {TRUNCATED} ELSE {SOUND} END AS fault
  FROM numbered
), search AS (
  SELECT conv, max(i) AS i, {inserted.format(final)} AS v FROM marked GROUP BY conv
  UNION ALL
  SELECT s.conv, s.i - 1, {searched} FROM search AS s JOIN marked AS x ON x.conv IS NOT DISTINCT FROM s.conv AND x.i = s.i WHERE s.i > 0
), solved AS (
  SELECT conv, CAST(left(v[1], 10) AS BIGINT) AS cost, substr(v[1], 11) AS audit FROM search WHERE i = 0
), edits AS (
  SELECT conv, p, substr(audit, CAST(p AS INT), 1) AS edit FROM (SELECT conv, audit, unnest(range(1, length(audit) + 1)) AS p FROM solved)
), placed AS (
  SELECT *, sum(CASE WHEN edit = 'I' THEN 0 ELSE 1 END) OVER (PARTITION BY conv ORDER BY p) AS i FROM edits
), left_over AS (
  SELECT e.conv, p, edit, x.kind, x.role, x.text, row_number() OVER (PARTITION BY e.conv ORDER BY p) - 1 AS place
  FROM placed AS e LEFT JOIN marked AS x ON edit <> 'I' AND x.conv IS NOT DISTINCT FROM e.conv AND x.i = e.i WHERE edit <> 'D'
), roled AS (
  SELECT *, max(CASE WHEN place = 0 AND edit = 'K' AND kind = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY conv) AS opened FROM left_over
), shas AS (
  SELECT conv, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (place - opened) % 2 = 0 THEN 'user' ELSE 'assistant' END
    || ':' || coalesce(text, ''), chr(10) ORDER BY place)) AS sha FROM roled GROUP BY conv
), pairs AS (
  SELECT *, lag(kind) OVER (PARTITION BY conv ORDER BY i) AS kind_before FROM marked
), figures AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = {BLANK}) AS blank, count(*) FILTER (fault = {DUPLICATE}) AS duplicate, count(*) FILTER (fault = {TRUNCATED}) AS truncated,
    count(*) FILTER (kind_before IS NOT NULL AND (kind_before, kind) NOT IN ({', '.join(map(str, sorted(_LEGAL)))})) AS illegal
  FROM pairs GROUP BY conv
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
  coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS c
LEFT JOIN figures AS f ON f.conv IS NOT DISTINCT FROM c.conv_id
LEFT JOIN solved AS s ON s.conv IS NOT DISTINCT FROM c.conv_id
LEFT JOIN shas AS h ON h.conv IS NOT DISTINCT FROM c.conv_id
"""


ORACLE = _oracle()

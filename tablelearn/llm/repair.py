"""Conversation structure repair by iterative-deepening A*.

A conversation's role initials must read ``(s?(ua)+)?``. Edits: Keep (0), Rerole to user or
assistant (2), Delete (3, the only way for blank and duplicate rows), Insert an empty user or
assistant turn (2); a truncated row that stays adds 1. What a Rerole or an Insert makes is
given by the turns before it, so a search node is (rows read, last role). ``search`` walks
depth-first in ASCII order of the edits under a bound on cost so far plus forced costs, raises
the bound by the least excess met, and keeps for each failed node the cost it is now known to
need at least. The first accepting path under the least bound that has one is the cheapest,
and of the cheapest the first in ASCII order.

Rows are range-partitioned and sorted by (conversation, turn, role, text): no conversation
need fit one task. Each task cuts its stream into chunks of at most ``chunk_rows`` rows of one
conversation. A conversation that lies in one chunk, away from both ends of its task, is
repaired there and then. All others are *open*: the first occurrence of each of their rows is
found by an aggregate, each chunk is searched from each role before it to each role behind it
(Inserts belong to the row that follows them), and the chunks' cheapest paths are put together
per conversation. Of two paths of a chunk none begins with the other, because both end with
the same number of rows read, so the first in ASCII order can be chosen chunk by chunk.
Putting together reads a few hundred bytes a chunk; by contract the audit is one string.

Defined results: null roles and texts count as one space (a blank row); null turns come first;
ties of a turn go by role, then text; of repeated rows the first stays, the others are
duplicates; null ids form one conversation; very long texts are read whole (a chunk also ends
at ``chunk_chars``); an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, spill, text_bytes_conf

START, SYSTEM, USER, ASSISTANT = range(4)  # the last role so far
INITIALS = {"s": 0, "u": 1, "a": 2}
OTHER, NONE = 3, 4  # another initial; no initial: an empty role, which adds nothing to the roles read
KINDS = "sua-."
OK, TRUNCATED, DUPLICATE, BLANK = range(4)
#: state -> state behind a kept row of each initial (None: not legal there).
KEEP = ((SYSTEM, USER, None, None, START), (None, USER, None, None, SYSTEM), (None, None, ASSISTANT, None, USER),
        (None, USER, None, None, ASSISTANT))
#: state -> state behind an Insert or a Rerole.
MADE = (USER, USER, ASSISTANT, USER)
#: state -> Inserts that finish a conversation.
TAIL = ("", "II", "I", "")
NEVER = 1 << 30
LEGAL = ("su", "ua", "au")


def damage(conversations: DataFrame) -> DataFrame:
    """Faults to repair, by crc32("conv_id:turn") % 20: 0 drops a row, 1 empties its text,
    2 takes its ``.!?``, 3 repeats it, 4 makes it a user's. Nulls count as one space."""
    c = pick(conversations, **{n: n for n in ("conv_id", "turn", "role", "text")})
    name = F.concat(*[F.coalesce(F.col(n).cast("string"), F.lit(" ")) if n else F.lit(":") for n in ("conv_id", "", "turn")])
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    c = c.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(name.cast("binary")) % 20).alias("k"))
    k = F.col("k")
    return c.where(k != 0).select(
        "conv_id", "turn", F.when(k == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(k == 1, "").when(k == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(k == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")


def mark(role: str, text: str, seen: bool = False) -> str:
    """One letter a row: its initial and its first fault."""
    body = text.rstrip(" \t\n\x0b\x0c\r")
    fault = BLANK if not body else DUPLICATE if seen else OK if body[-1] in ".!?" else TRUNCATED
    return letter(fault, initial_of(role))


def initial_of(role: str) -> int:
    return INITIALS.get(role[:1], OTHER) if role else NONE


def letter(fault: int, initial: int) -> str:
    return chr(65 + len(KINDS) * fault + initial)


def unmark(letter: str) -> tuple[int, int]:
    """(fault, initial)"""
    return divmod(ord(letter) - 65, len(KINDS))


def search(marks: str, state: int = START, exit: int | None = None,
           needs: dict[tuple[int, int], int] | None = None) -> str | None:
    """The cheapest edits from ``state`` over all rows, the first in ASCII order of several:
    to a finished conversation, or to the role ``exit`` right behind the last row read.
    ``needs`` holds failed nodes with the cost to go known so far; searches of the same rows
    and goal may share it."""
    rows, n = [unmark(m) for m in marks], len(marks)
    if exit is not None and not (exit >= USER or exit == state or exit == SYSTEM and state == START and any(
            fault < DUPLICATE and initial == 0 for fault, initial in rows)):
        return None
    forced = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        fault, initial = rows[i]
        forced[i] = forced[i + 1] + (3 if fault >= DUPLICATE else fault + (2 if initial == OTHER else 0))
    needs = {} if needs is None else needs
    path: list[str] = []

    def floor(i: int, at: int) -> int:
        """What the goal costs at least from here: the forced costs; to leave no user or
        assistant behind, every row but one system row must go."""
        if exit is None or exit >= USER:
            return forced[i]
        return NEVER if at > exit or at < exit and i == n else 3 * (n - i - (at < exit))

    def walk(i: int, at: int, left: int) -> int:
        """0 if ``path`` now leads to the goal at a cost of at most ``left``, else the least excess."""
        need = needs.get((i, at), floor(i, at))
        if need > left:
            return need - left
        if i == n and (at == exit or exit is None and not TAIL[at]):
            return 0
        least = NEVER
        for edit, cost, j, to in steps(i, at):
            path.append(edit)
            over = walk(j, to, left - cost) if cost <= left else cost - left + needs.get((j, to), floor(j, to))
            if not over:
                return 0
            path.pop()
            least = min(least, over)
        needs[i, at] = left + least
        return least

    def steps(i: int, at: int) -> Iterator[tuple[str, int, int, int]]:
        if i == n:
            if exit is None:
                yield "I", 2, i, MADE[at]
            return
        fault, initial = rows[i]
        yield "D", 3, i + 1, at
        yield "I", 2, i, MADE[at]
        if fault < DUPLICATE:
            if KEEP[at][initial] is not None:
                yield "K", fault, i + 1, KEEP[at][initial]
            yield "R", 2 + fault, i + 1, MADE[at]

    bound = floor(0, state)
    while over := walk(0, state, bound):
        bound += over
    return "".join(path)


def cost(marks: str, audit: str) -> int:
    total, i = 0, 0
    for edit in audit:
        total += {"K": 0, "R": 2, "D": 3, "I": 2}[edit]
        if edit != "I":
            total += edit != "D" and unmark(marks[i])[0] == TRUNCATED
            i += 1
    return total


def apply(audit: str, state: int, turns: list, roles: list, texts: list) -> tuple[list, list, list]:
    """The repaired rows; inserted ones have no turn."""
    out, i = ([], [], []), 0
    for edit in audit:
        row = (None, None, "") if edit == "I" else (turns[i], roles[i], texts[i])
        i += edit != "I"
        if edit == "D":
            continue
        state = KEEP[state][initial_of(row[1])] if edit == "K" else MADE[state]
        made = row[1] if edit == "K" else "user" if state == USER else "assistant"
        for column, value in zip(out, (row[0], made, row[2])):
            column.append(value)
    return out


def _columns(conv_type: str) -> str:
    return (f"conv_id {conv_type}, part bigint, chunk bigint, open boolean, turns array<bigint>, roles array<string>, "
            "texts array<string>, marks string, keys array<binary>, new_turns array<bigint>, new_roles array<string>, "
            "new_texts array<string>, audit string")


def _chunks(c: DataFrame, chunk_rows: int, chunk_chars: int) -> DataFrame:
    """Chunks of the sorted rows; those of closed conversations are repaired, the others hold
    their rows and the rows' hashes."""
    schema = _columns(c.schema["conv_id"].dataType.simpleString())
    names = [x.split()[0] for x in schema.split(", ")]

    def chunk_of(conv, part, number, rows, opened):
        turns, roles, texts = map(list, zip(*rows))
        if opened:
            keys = [hashlib.md5(f"{len(r)}:{r}{t}".encode("utf-8", "surrogatepass")).digest() for r, t in zip(roles, texts)]
            return (conv, part, number, True, turns, roles, texts, "".join(map(mark, roles, texts)), keys, None, None, None, None)
        seen, marks = set(), []
        for r in zip(roles, texts):
            marks.append(mark(*r, r in seen))
            seen.add(r)
        marks = "".join(marks)
        audit = search(marks)
        return (conv, part, number, False, turns, None, None, marks, None, *apply(audit, START, turns, roles, texts), audit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, schema_out = TaskContext.get().partitionId(), 0, None
        out: list[tuple] = []
        conv, rows, chars, opened = None, [], 0, True  # a task's first conversation may begin in another

        def record(block):
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*block), types)], names)

        for b in batches:
            if schema_out is None:
                schema_out = types = [b.schema.field("conv_id").type, pa.int64(), pa.int64(), pa.bool_(),
                                      pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.string()), pa.string(),
                                      pa.list_(pa.binary()), pa.list_(pa.int64()), pa.list_(pa.string()),
                                      pa.list_(pa.string()), pa.string()]
            for row in zip(*(b.column(x).to_pylist() for x in ("conv_id", "turn", "role", "text"))):
                if rows and row[0] != conv:
                    out.append(chunk_of(conv, part, number, rows, opened))
                    number, rows, chars, opened = number + 1, [], 0, False
                elif len(rows) >= chunk_rows or rows and chars + len(row[3]) > chunk_chars:
                    out.append(chunk_of(conv, part, number, rows, True))
                    number, rows, chars, opened = number + 1, [], 0, True
                conv = row[0]
                rows.append(row[1:])
                chars += len(row[3])
            if out:
                yield record(out)
                out = []
        if rows:  # the last conversation may go on in the next task
            yield record([chunk_of(conv, part, number, rows, True)])

    return c.mapInArrow(run, schema)


def _mark_duplicates(chunks: DataFrame) -> DataFrame:
    """Open chunks with ``again``: the positions whose row stands earlier in the conversation."""
    rows = chunks.select("conv_id", "part", "chunk", F.posexplode("keys").alias("pos", "key"))
    place = F.struct("part", "chunk", "pos")
    first = rows.groupBy(F.col("conv_id").alias("c"), F.col("key").alias("k")).agg(
        F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = rows.join(first, rows["conv_id"].eqNullSafe(F.col("c")) & (F.col("key") == F.col("k"))).where(place > F.col("first"))
    again = again.groupBy("part", "chunk").agg(F.collect_list("pos").alias("again"))
    return chunks.select("conv_id", "part", "chunk", "marks").join(again, ["part", "chunk"], "left")


def _search_chunks(marked: DataFrame, conv_type: str) -> DataFrame:
    """conv_id, part, chunk, marks, paths: of each role before (outer) and behind (inner)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            all_marks, paths = [], []
            for marks, again in zip(b.column("marks").to_pylist(), b.column("again").to_pylist()):
                letters = list(marks)
                for i in again or ():
                    fault, initial = unmark(letters[i])
                    letters[i] = letter(max(fault, DUPLICATE), initial)
                marks = "".join(letters)
                all_marks.append(marks)
                known: list[dict] = [{} for _ in range(4)]
                paths.append([search(marks, a, z, known[z]) for a in range(4) for z in range(4)])
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id"), b.column("part"), b.column("chunk"), pa.array(all_marks, pa.string()),
                 pa.array(paths, pa.list_(pa.string()))], ["conv_id", "part", "chunk", "marks", "paths"])

    # few bytes and much work a row: not for the optimiser to put together into one task
    tasks = int(marked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return marked.select("conv_id", "part", "chunk", "marks", "again").repartition(tasks, "part", "chunk").mapInArrow(
        run, f"conv_id {conv_type}, part bigint, chunk bigint, marks string, paths array<string>")


def _compose(searched: DataFrame) -> DataFrame:
    """part, chunk, marks, state (the role before), audit of every open chunk: costs to go from
    the last chunk back, then the first cheapest path of each chunk from the first on."""
    chunks = searched.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("part", "chunk", "marks", "paths"))).alias("c"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for cs in b.column("c").to_pylist():
                togo = [[2 * len(t) for t in TAIL]]
                costs = [[NEVER if p is None else cost(c["marks"], p) for p in c["paths"]] for c in cs]
                for m in reversed(costs):
                    togo.append([min(m[4 * a + z] + togo[-1][z] for z in range(4)) for a in range(4)])
                togo.reverse()
                at = START
                for k, c in enumerate(cs):
                    last = k == len(cs) - 1
                    audit, to = min((c["paths"][4 * at + z] + (TAIL[z] if last else ""), z) for z in range(4)
                                    if costs[k][4 * at + z] + togo[k + 1][z] == togo[k][at])
                    out.append((c["part"], c["chunk"], c["marks"], at, audit))
                    at = to
            if out:
                types = (pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)],
                                                 ["part", "chunk", "marks", "state", "audit"])

    return chunks.select("c").mapInArrow(run, "part bigint, chunk bigint, marks string, state int, audit string")


def _apply(opened: DataFrame, conv_type: str) -> DataFrame:
    names = ["conv_id", "part", "chunk", "turns", "marks", "new_turns", "new_roles", "new_texts", "audit"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new = [apply(*x) for x in zip(*(b.column(c).to_pylist() for c in ("audit", "state", "turns", "roles", "texts")))]
            turns, roles, texts = zip(*new) if new else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in names[:5]), pa.array(turns, pa.list_(pa.int64())),
                 pa.array(roles, pa.list_(pa.string())), pa.array(texts, pa.list_(pa.string())), b.column("audit")], names)

    return opened.select(*names[:5], "roles", "texts", "state", "audit").mapInArrow(
        run, f"conv_id {conv_type}, part bigint, chunk bigint, turns array<bigint>, marks string, new_turns array<bigint>, "
             "new_roles array<string>, new_texts array<string>, audit string")


def repair(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", chunk_rows: int = 64, chunk_chars: int = 4 << 20, partitions: int | None = None) -> DataFrame:
    """One row a chunk, in order by (part, chunk): conv_id, turns (as they were), marks, audit,
    and the repaired new_turns, new_roles, new_texts."""
    c = pick(conversations, conv_id=id_col, turn=turn_col, role=role_col, text=text_col)
    c = c.select("conv_id", F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
                 F.coalesce("text", F.lit(" ")).alias("text"))
    text_bytes_conf(c.sparkSession)
    by = (F.col("conv_id"), F.col("turn"), F.col("role"), F.substring("text", 1, 64))
    c = c.repartitionByRange(partitions, *by) if partitions else c.repartitionByRange(*by)
    chunks = spill(_chunks(c.sortWithinPartitions("conv_id", "turn", "role", "text"), chunk_rows, chunk_chars), "repair-chunks")
    conv_type = chunks.schema["conv_id"].dataType.simpleString()
    opened = chunks.where("open")
    paths = _compose(_search_chunks(_mark_duplicates(opened), conv_type))
    opened = _apply(opened.drop("marks", "audit").join(paths, ["part", "chunk"]), conv_type)
    closed = chunks.where("not open").select(*opened.columns)
    return closed.unionByName(opened)


def rows(repaired: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, part, chunk, pos (together the order), turn, role, text."""
    r = repaired.select("conv_id", "part", "chunk", F.posexplode(F.arrays_zip("new_turns", "new_roles", "new_texts")).alias("pos", "r"))
    return r.select("conv_id", "part", "chunk", "pos", F.col("r.new_turns").alias("turn"), F.col("r.new_roles").alias("role"),
                    F.col("r.new_texts").alias("text"))


def _count(text, letters: str):
    return F.length(text) - F.length(F.translate(text, letters, ""))


def _letters(*faults: int) -> str:
    return "".join(letter(f, i) for f in faults for i in range(len(KINDS)))


def digest(repaired: DataFrame) -> DataFrame:
    """One row a conversation: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    initials = F.translate("marks", _letters(OK, TRUNCATED, DUPLICATE, BLANK), KINDS * 4)
    kept = F.filter("turns", lambda t: t.isNotNull())
    cut = _count(F.col("marks"), _letters(TRUNCATED))
    r = repaired.select(
        "conv_id", "part", "chunk", F.array_distinct(kept).alias("turns"), initials.alias("initials"), "marks", "audit",
        F.transform(F.arrays_zip("new_roles", "new_texts"), lambda x: F.concat(x["new_roles"], F.lit(":"), x["new_texts"])).alias("lines"))
    body = F.when(F.size("lines") > 0, F.array_join("lines", "\n"))
    # truncated rows that stay add 1: walk the audit without its Inserts beside the marks
    fates = F.translate("audit", "I", "")
    stay = F.size(F.filter(F.sequence(F.lit(1), F.length(fates)), lambda i: (F.substr("marks", i, F.lit(1)).isin(
        *_letters(TRUNCATED))) & (F.substr(fates, i, F.lit(1)) != "D")))
    r = r.withColumns({"body": body, "cost": 3 * _count(F.col("audit"), "D") + 2 * _count(F.col("audit"), "IR") + stay,
                       "blank": _count(F.col("marks"), _letters(BLANK)), "cut": cut,
                       "duplicate": _count(F.col("marks"), _letters(DUPLICATE))})
    spilled = spill(r.drop("marks", "lines"), "repair-digest")
    parts = F.sort_array(F.collect_list(F.struct("part", "chunk", "turns", "initials", "audit")))
    one = spilled.groupBy("conv_id").agg(
        parts.alias("p"), *[F.sum(F.col(c).cast("bigint")).alias(c) for c in ("cost", "blank", "duplicate", "cut")])
    all_turns = F.flatten(F.transform("p", lambda x: x["turns"]))
    initials = F.array_join(F.transform("p", lambda x: x["initials"]), "")
    one = one.withColumns({"all_turns": F.array_distinct(all_turns), "all_initials": initials})
    pairs = F.when(F.length("all_initials") > 1, F.sequence(F.lit(1), F.length("all_initials") - 1)).otherwise(
        F.array().cast("array<int>"))
    illegal = F.size(F.filter(pairs, lambda i: ~F.substr("all_initials", i, F.lit(2)).isin(*LEGAL)))
    gaps = F.array_max("all_turns") - F.array_min("all_turns") + 1 - F.size("all_turns")
    one = one.select("conv_id", F.size("p").alias("n_chunks"), F.coalesce(gaps, F.lit(0)).cast("bigint").alias("gaps"), "blank",
                     "duplicate", F.col("cut").alias("truncated"), illegal.cast("bigint").alias("illegal"), "cost",
                     F.array_join(F.transform("p", lambda x: x["audit"]), "").alias("audit"))
    return one.join(_digests(spilled), one["conv_id"].eqNullSafe(F.col("of"))).drop("of", "n_chunks")


def _digests(chunks: DataFrame) -> DataFrame:
    """of, repaired_sha256: a conversation's bodies in the order of its chunks, as a stream."""
    conv_type = chunks.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, lines = None, None, False

        for b in batches:
            key_type, ids, out = b.schema.field("conv_id").type, [], []
            for conv, body in zip(b.column("conv_id").to_pylist(), b.column("body").to_pylist()):
                if state is None or conv != at:
                    if state is not None:
                        ids.append(at)
                        out.append(state.hexdigest())
                    at, state, lines = conv, hashlib.sha256(), False
                if body is not None:
                    state.update((("\n" if lines else "") + body).encode("utf-8", "surrogatepass"))
                    lines = True
            yield pa.RecordBatch.from_arrays([pa.array(ids, key_type), pa.array(out, pa.string())], ["of", "repaired_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at], key_type), pa.array([state.hexdigest()])], ["of", "repaired_sha256"])

    ordered = chunks.select("conv_id", "part", "chunk", "body").repartition("conv_id").sortWithinPartitions("conv_id", "part", "chunk")
    return ordered.select("conv_id", "body").mapInArrow(run, f"of {conv_type}, repaired_sha256 string")

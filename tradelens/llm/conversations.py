"""Repair of conversations by cheapest edits, solved once for each distinct remainder of a conversation.

A row counts by its symbol: ``s``, ``u``, ``a`` for the initial of its role, ``o`` for any other, in upper case where
its text is truncated, ``x`` where it has to be deleted. The symbols of a conversation in order are its signature.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradelens.llm.common import cut

SPACE = " \t\n\x0b\f\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Rows of a conversation that are solved together; longer ones are joined from parts.
PART_ROWS = 256

#: States of the grammar (s?(ua)+)?: nothing yet, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: Inserts that end a conversation in each state; their number is what they cost in units of INSERT.
ENDINGS = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}

Ways = dict[tuple[int, int], tuple[int, str]]


def _steps(symbol: str) -> Ways:
    """Cheapest edits for one row from state to state, inserts before it included: (cost, initials), ties ASCII-least."""
    out: Ways = {}
    extra = TRUNCATED if symbol.isupper() else 0
    for start in STATES:
        state, cost, edits = start, 0, ""
        # more inserts than these only come back to a state
        for _ in range(4):
            options = [(state, DELETE, "D")]
            if symbol != "x":
                options += [(NEXT.get((state, symbol.lower())), KEEP + extra, "K")] + [(NEXT.get((state, r)), REROLE + extra, "R") for r in "ua"]
            for end, more, edit in options:
                if end is not None:
                    way = (cost + more, edits + edit)
                    out[start, end] = min(out.get((start, end), way), way)
            state, cost, edits = NEXT[state, "a" if state == USER else "u"], cost + INSERT, edits + "I"
    return out


STEPS = {symbol: _steps(symbol) for symbol in "suaoSUAOx"}


def joined(first: Ways, second: Ways) -> Ways:
    """Cheapest edits through two stretches of rows. Edits of one stretch between the same states and of equal cost never are a prefix of each other, so each stretch's least stays the least."""
    out: Ways = {}
    for (start, middle), (cost, edits) in first.items():
        for end in STATES:
            if rest := second.get((middle, end)):
                way = (cost + rest[0], edits + rest[1])
                out[start, end] = min(out.get((start, end), way), way)
    return out


def finished(ways: Ways) -> tuple[int, str]:
    """Cost and edits from the start to a legal end."""
    return min((cost + INSERT * len(ENDINGS[end]), edits + ENDINGS[end]) for (start, end), (cost, edits) in ways.items() if start == START)


class SuffixAutomaton:
    """Signatures that come sorted from their ends share the nodes of their common end.

    A node stands for one remainder of signatures and holds, for each state of the grammar it may be entered in, the cost to go
    and the best edits to each state it may be left in. Only the nodes of the signature at hand are kept.
    """

    def __init__(self):
        self.path, self.nodes = "", [{(q, q): (0, "") for q in STATES}]
        self.made = 0

    def ways(self, signature: str) -> Ways:
        backward, shared = signature[::-1], 0
        most = min(len(backward), len(self.path))
        while shared < most and backward[shared] == self.path[shared]:
            shared += 1
        del self.nodes[shared + 1 :]
        for symbol in backward[shared:]:
            self.nodes.append(joined(STEPS[symbol], self.nodes[-1]))
            self.made += 1
        self.path = backward
        return self.nodes[-1]


def _solve(batches):
    """Ways through each part of a conversation: of a first part only those from the start."""
    import pyarrow as pa

    entries = pa.list_(pa.struct([("q", pa.int32()), ("t", pa.int32()), ("cost", pa.int64()), ("edits", pa.string())]))
    automaton = SuffixAutomaton()
    for b in batches:
        found = [
            [(q, t, *way) for (q, t), way in sorted(automaton.ways(signature).items()) if part or q == START]
            for signature, part in zip(b.column("signature").to_pylist(), b.column("part").to_pylist(), strict=True)
        ]
        yield pa.record_batch([*[b.column(c) for c in b.schema.names if c != "signature"], pa.array(found, entries)], names=[*[c for c in b.schema.names if c != "signature"], "ways"])


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults put in by crc32 of ``conv_id:turn`` modulo 20, as test data for the repair.

    0 drops the row (it stays with ``dropped`` set, so its conversation is known), 1 empties its text, 2 removes ``.``, ``!`` and ``?``, 3
    repeats it, 4 makes it the user's. A null in role or text, and in what is hashed, counts as one space.
    """
    key = F.concat(*[F.coalesce(x, F.lit(" ")) for x in (F.col("conv_id").cast("string"), F.lit(":"), F.col("turn").cast("string"))])
    rows = rows.select("conv_id", "turn", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")], (F.crc32(key.cast("binary")) % 20).alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("fault") == 0).alias("dropped"), F.explode(times).alias("copy")).drop("copy")


def _plain(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, dropped; nulls of role and text as one space."""
    dropped = F.coalesce(F.col("dropped"), F.lit(False)) if "dropped" in rows.columns else F.lit(False)
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")], dropped.alias("dropped"))


def row_faults(rows: DataFrame) -> DataFrame:
    """Each row's place in its conversation, first fault and symbol, without its text.

    conv_id, turn, dropped, place (from 1, dropped rows last), fault (blank, duplicate, truncated or null), illegal (its initial may
    not follow the one before), new_turn (the first row of its turn), symbol. Texts are compared by their SHA-256.
    """
    text = F.rtrim(F.col("text"), F.lit(SPACE))
    facts = _plain(rows).select(
        "conv_id", "turn", "role", "dropped", F.sha2("text", 256).alias("digest"), (text == "").alias("blank"), (~F.substring(text, -1, 1).isin(".", "!", "?")).alias("open")
    )
    # one shuffle serves both windows: what is equal within a conversation is in its partition
    facts = facts.repartition("conv_id")
    in_order = W.partitionBy("conv_id").orderBy("dropped", F.asc_nulls_first("turn"), "role", "digest")
    equal = W.partitionBy("conv_id", "dropped", "role", "digest").orderBy(F.asc_nulls_first("turn"))
    initial = F.substring("role", 1, 1)
    pair = F.concat(F.lag(initial).over(in_order), initial)
    facts = facts.withColumn("seen", F.row_number().over(equal) > 1)
    facts = facts.withColumns({"place": F.row_number().over(in_order), "illegal": F.coalesce(~pair.isin("su", "ua", "au"), F.lit(False)), "new_turn": F.col("turn").isNotNull() & ~F.col("turn").eqNullSafe(F.lag("turn").over(in_order))})
    fault = F.when(F.col("blank"), "blank").when(F.col("seen"), "duplicate").when(F.col("open"), "truncated")
    symbol = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    facts = facts.withColumn("fault", fault)
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.upper(symbol)).otherwise(symbol)
    return facts.select("conv_id", "turn", "dropped", "place", "fault", "illegal", "new_turn", symbol.alias("symbol"))


COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")


def _parts(rows: DataFrame) -> DataFrame:
    """Signature and counts of each stretch of ``PART_ROWS`` rows: conv_id, part, signature, counts, least and most (turns)."""
    live = ~F.col("dropped")
    counted = {c: F.col("fault").eqNullSafe(F.lit(c)) for c in COUNTS[:3]} | {"illegal": F.col("illegal"), "turns": F.col("new_turn")}
    sums = [F.sum((x & live).cast("long")).alias(c) for c, x in counted.items()]
    part = F.when(live, F.floor((F.col("place") - 1) / PART_ROWS)).otherwise(0).cast("int")
    ordered = F.array_sort(F.collect_list(F.when(live, F.struct("place", "symbol"))))
    turn = F.when(live, F.col("turn"))
    out = row_faults(rows).groupBy("conv_id", part.alias("part")).agg(F.array_join(F.transform(ordered, lambda x: x["symbol"]), "").alias("signature"), *sums, F.min(turn).alias("least"), F.max(turn).alias("most"))
    return cut(out, "parts")


class Replay:
    """One conversation: the ways through its parts are joined as they come, then the edits are applied to its rows."""

    def __init__(self, conv_id):
        self.conv_id, self.state, self.at = conv_id, START, 0
        self.front: Ways = {(START, START): (0, "")}
        self.counts, self.least, self.most = dict.fromkeys(COUNTS, 0), None, None
        self.cost, self.edits = 0, ""

    def part(self, ways: list[dict], counts: dict, least: int | None, most: int | None) -> None:
        self.front = joined(self.front, {(w["q"], w["t"]): (w["cost"], w["edits"]) for w in ways})
        self.cost, self.edits = finished(self.front)
        for c in COUNTS:
            self.counts[c] += counts[c]
        if least is not None:
            self.least = least if self.least is None else min(least, self.least)
            self.most = most if self.most is None else max(most, self.most)

    def _turn(self, edit: str, role: str, text: bytes) -> tuple[str, str, bytes]:
        due = "assistant" if self.state == USER else "user"
        self.state = NEXT[self.state, "s" if edit == "K" and role[:1] == "s" else due[0]]
        return edit, role if edit == "K" else due, text

    def inserts(self) -> Iterator[tuple[str, str, bytes]]:
        while self.edits[self.at : self.at + 1] == "I":
            self.at += 1
            yield self._turn("I", "", b"")

    def row(self, role: str, text: bytes) -> Iterator[tuple[str, str, bytes]]:
        """Turns that the next row gives: inserts before it, then itself unless it is deleted."""
        yield from self.inserts()
        edit = self.edits[self.at]
        self.at += 1
        if edit != "D":
            yield self._turn(edit, role, text)


def _replayed(visit: Callable, result: Callable):
    """Goes through sorted parts and rows; ``visit(replay, turns)`` sees each conversation's turns as they come, ``result`` gives batches of what it returns."""

    def run(batches: Iterable):
        replay, out, kind = None, [], None
        for b in batches:
            kind = b.schema.field("conv_id").type
            columns = [b.column(c).to_pylist() for c in ("conv_id", "kind", "ways", "counts", "least", "most", "role")]
            texts = b.column("text").cast("large_binary").to_pylist()
            for conv_id, is_row, ways, counts, least, most, role, text in zip(*columns, texts, strict=True):
                if replay is None or conv_id != replay.conv_id:
                    if replay is not None:
                        visit(replay, replay.inserts(), out, True)
                    replay = Replay(conv_id)
                if is_row:
                    visit(replay, replay.row(role, text), out, False)
                else:
                    replay.part(ways, counts, least, most)
            if out:
                yield result(out, kind)
                out = []
        if replay is not None:
            visit(replay, replay.inserts(), out, True)
            yield result(out, kind)

    return run


def _stream(rows: DataFrame) -> DataFrame:
    """Solved parts and rows of each conversation, in order and in one partition."""
    parts = _parts(rows)
    backward = parts.select("conv_id", "part", "signature", F.struct(*COUNTS).alias("counts"), "least", "most").repartitionByRange(F.reverse("signature"), "conv_id", "part")
    kind = rows.schema["conv_id"].dataType.simpleString()
    counts = ", ".join(f"{c}: bigint" for c in COUNTS)
    schema = f"conv_id {kind}, part int, counts struct<{counts}>, least bigint, most bigint, ways array<struct<q: int, t: int, cost: bigint, edits: string>>"
    solved = backward.sortWithinPartitions(F.reverse("signature")).mapInArrow(_solve, schema)
    turns = _plain(rows).where("not dropped").select("conv_id", F.lit(1).alias("kind"), "turn", "role", F.sha2("text", 256).alias("digest"), "text")
    both = solved.withColumn("kind", F.lit(0)).unionByName(turns, allowMissingColumns=True)
    keys = ["conv_id", "kind", "part", F.asc_nulls_first("turn"), "role", "digest"]
    return both.repartition("conv_id").sortWithinPartitions(*keys).select("conv_id", "kind", "ways", "counts", "least", "most", "role", "text")


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), edit (K, R or I), role, text. See ``repair_reports``."""

    def visit(replay, turns, out, end):
        for turn in turns:
            out.append((replay.conv_id, getattr(replay, "written", 0), *turn))
            replay.written = getattr(replay, "written", 0) + 1

    def result(out, kind):
        import pyarrow as pa

        columns = list(zip(*out, strict=True)) or [[]] * 5
        arrays = [pa.array(c, t) for c, t in zip(columns, [kind, pa.int64(), pa.string(), pa.string(), pa.large_binary()], strict=True)]
        return pa.record_batch([*arrays[:4], arrays[4].cast(pa.string())], names=["conv_id", "place", "edit", "role", "text"])

    kind = rows.schema["conv_id"].dataType.simpleString()
    return _stream(rows).mapInArrow(_replayed(visit, result), f"conv_id {kind}, place long, edit string, role string, text string")


def repair_reports(rows: DataFrame) -> DataFrame:
    """One row per conversation on its faults and its cheapest repair.

    ``rows``: conv_id, turn, role, text, and optionally ``dropped`` (true: the row only makes its conversation known). Rows are taken by turn
    (nulls first), those of one turn by role and digest of the text. Returns conv_id, gaps (turns missing between the least and the
    most), blank, duplicate, truncated (each row's first fault), illegal (adjacent initials other than su, ua, au), cost, audit and
    repaired_sha256 (of the repaired ``role:text``, joined by newlines).

    Edits: keep a row, give it the role that is due, delete it (blank and duplicate rows have to be), insert an empty turn; what they cost stands
    at the top. The result's initials are ``(s?(ua)+)?``; of the cheapest edits the ASCII-least are taken, which ``audit`` spells.

    * Rows become signatures in the JVM. Parts of ``PART_ROWS`` symbols are sorted by their ends, over all conversations, and each distinct end
      is a node that is solved once for each state of the grammar (once more where a range of the sort ends).
    * Parts come back to their conversation, where the ways through them are joined and the edits are applied to the rows as they pass, so a task
      holds a conversation's edits, not its texts. A digest of a whole conversation needs its rows in order in one task.

    A null conv_id is a conversation like others; null roles and texts count as one space. Repeated rows are duplicates. Without rows left:
    zeros, an empty audit and the digest of the empty string. An empty table gives an empty result; other columns are ignored.
    """

    def visit(replay, turns, out, end):
        digest = replay.__dict__.setdefault("digest", hashlib.sha256())
        for _, role, text in turns:
            digest.update(b"%s%s:%s" % (b"\n" if replay.__dict__.setdefault("begun", False) else b"", role.encode(), text))
            replay.begun = True
        if end:
            gaps = 0 if replay.least is None else replay.most - replay.least + 1 - replay.counts["turns"]
            out.append((replay.conv_id, gaps, *[replay.counts[c] for c in COUNTS[:4]], replay.cost, replay.edits, digest.hexdigest()))

    names = ["conv_id", "gaps", *COUNTS[:4], "cost", "audit", "repaired_sha256"]

    def result(out, kind):
        import pyarrow as pa

        types = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
        return pa.record_batch([pa.array(c, t) for c, t in zip(list(zip(*out, strict=True)) or [[]] * 9, types, strict=True)], names=names)

    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, {', '.join(f'{c} long' for c in names[1:7])}, audit string, repaired_sha256 string"
    return _stream(rows).mapInArrow(_replayed(visit, result), schema)

"""Chat formatting: conversations as text segments with loss flags, from a declarative template.

A template names the states of a finite-state machine, the role that leads from one to the next, and what stands before and after
a turn of each role. Turns that the machine does not allow are marked, and it goes on from the state of their role; a role that
the template does not know leaves the state as it is. Either way the turn is formatted, so nothing is lost.

Control strings inside roles and texts are escaped: between ``<`` and ``|``, and between ``<`` and backslashes before ``|``, one
more backslash is put, so that ``<|`` only ever comes from the template, and taking one out again gives the text back. Line feeds
and backslashes in roles are escaped, too.

All turns of a conversation go through one task in order, as a stream, whatever their number: no conversation is held as a whole. A
conversation that has a large part of all rows is cut along its turns into pieces for several tasks; what the machine makes of
each piece, from any state, is worked out first from the roles alone, so that every piece starts in the right state.

Null texts and null roles are empty. Conversations with a null id are one conversation. Null turns come first; turns of equal number
follow by role, then text, and repeated rows are turns each. No rows, no turns.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from braid.operators.skew import heavy_hashes, key_hash, partitions


@dataclass(frozen=True)
class Template:
    """``follows``: state -> role -> next state. ``loss``: the roles whose texts are learnt. ``ends``: states in which a
    conversation is complete. ``opens`` and ``closes`` stand around a text, with ``{role}`` for the role's name."""

    follows: dict[str, dict[str, str]]
    loss: tuple[str, ...] = ("assistant",)
    ends: tuple[str, ...] = ("assistant",)
    start: str = "start"
    opens: str = "<|im_start|>{role}\n"
    closes: str = "<|im_end|>\n"
    # The state after a turn that the machine does not allow, by its role.
    enters: dict[str, str] = field(default_factory=dict)

    @property
    def states(self) -> list[str]:
        return sorted({self.start, *self.follows, *(s for after in self.follows.values() for s in after.values()), *self.enters.values()})

    def step(self, state: str, role: str) -> tuple[str, bool]:
        """The state after a turn, and whether the turn is allowed."""
        after = self.follows.get(state, {}).get(role)
        return (after, True) if after is not None else (self.enters.get(role, state), False)

    def segments(self, role: str, text: str) -> list[dict]:
        return [
            {"text": self.opens.replace("{role}", escaped_role(role)), "loss": False},
            {"text": escaped(text), "loss": role in self.loss},
            {"text": self.closes, "loss": False},
        ]

    def turns(self, formatted: str) -> Iterator[tuple[str, str]]:
        """The roles and texts back from formatted turns."""
        before, after = self.opens.split("{role}")
        turn = re.compile(re.escape(before) + r"([^\n]*?)" + re.escape(after) + "(.*?)" + re.escape(self.closes), re.DOTALL)
        at = 0
        while at < len(formatted):
            found = turn.match(formatted, at)
            if found is None:
                raise ValueError("not a text of this template")
            yield original_role(found[1]), original(found[2])
            at = found.end()


CHAT = Template(
    follows={
        "start": {"system": "system", "user": "user"},
        "system": {"user": "user"},
        "user": {"assistant": "assistant"},
        "assistant": {"user": "user"},
    },
    enters={"system": "system", "user": "user", "assistant": "assistant"},
)


def escaped(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def original(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escaped_role(role: str) -> str:
    return escaped(role.replace("\\", "\\\\").replace("\n", "\\n"))


def original_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], original(role))


def format_turns(turns: DataFrame, template: Template = CHAT, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per turn: id, ``piece``, ``place`` (in the piece, from 0), ``turn``, ``state`` (after it), ``allowed`` and
    ``segments`` (text, loss). A partition holds whole pieces, each in order, one after the other; only conversations with a
    large part of all rows have more than one."""
    return formatted_pieces(turns, template, id_col, turn_col, role_col, text_col)[0]


def formatted_pieces(turns: DataFrame, template: Template = CHAT, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, list]:
    """``format_turns``, and the conversations that were cut, for ``read_back``."""
    rows = turns.select(
        F.col(id_col).alias("id"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    rows, begins = _pieces(rows, template)
    kinds = {name: rows.schema[name].dataType for name in ("id", "turn")}
    segment = T.ArrayType(T.StructType([T.StructField("text", T.StringType()), T.StructField("loss", T.BooleanType())]))
    schema = T.StructType([
        T.StructField(id_col, kinds["id"]), T.StructField("piece", T.IntegerType()), T.StructField("place", T.LongType()), T.StructField("turn", kinds["turn"]),
        T.StructField("state", T.StringType()), T.StructField("allowed", T.BooleanType()), T.StructField("segments", segment),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, place = None, template.start, 0
        for batch in batches:
            ids, pieces = batch.column("id").to_pylist(), batch.column("piece").to_pylist()
            out: dict[str, list] = {"place": [], "state": [], "allowed": [], "segments": []}
            for piece_of, role, text in zip(zip(ids, pieces, strict=True), batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if piece_of != current:
                    current, state, place = piece_of, begins.get(piece_of, template.start), 0
                state, allowed = template.step(state, role)
                for name, value in (("place", place), ("state", state), ("allowed", allowed), ("segments", template.segments(role, text))):
                    out[name].append(value)
                place += 1
            arrow = pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))
            columns = {id_col: batch.column("id"), "piece": batch.column("piece"), "place": pa.array(out["place"], pa.int64()), "turn": batch.column("turn")}
            columns |= {"state": pa.array(out["state"], pa.string()), "allowed": pa.array(out["allowed"], pa.bool_()), "segments": pa.array(out["segments"], arrow)}
            yield pa.RecordBatch.from_pydict(columns)

    return rows.repartition("id", "piece").sortWithinPartitions("id", "piece", "turn", "role", "text").mapInArrow(run, schema), sorted({key[0] for key in begins}, key=str)


def _pieces(rows: DataFrame, template: Template) -> tuple[DataFrame, dict]:
    """The rows with their ``piece``, and the states in which later pieces begin. A conversation is cut if it has more rows than
    half of an even share of a task; there are at most four cuts a task in all."""
    tasks = partitions(rows)
    hashed = key_hash(rows, ["id"])
    heavy, total = heavy_hashes(rows, hashed, 1 / (2 * tasks))
    wanted: dict[int, list[int]] = {}
    for item, count in heavy.items():
        wanted.setdefault(1 << max(1, math.ceil(math.log2(2 * tasks * count / total))), []).append(item)
    cuts: dict[int, list] = {}
    for pieces, items in wanted.items():
        at = F.percentile_approx("turn", [i / pieces for i in range(1, pieces)])
        for row in rows.filter(hashed.isin(items)).groupBy(hashed.alias("h")).agg(at.alias("at")).collect():
            cuts[row["h"]] = sorted(set(row["at"] or []))
    cuts = {item: at for item, at in cuts.items() if at}
    if not cuts:
        return rows.withColumn("piece", F.lit(0)), {}
    # Turns of one number stay together.
    kind = rows.schema["turn"].dataType
    chosen = F.element_at(F.create_map(*[x for item, at in cuts.items() for x in (F.lit(item), F.array(*[F.lit(a).cast(kind) for a in at]))]), hashed)
    rows = rows.withColumn("piece", F.coalesce(F.size(F.filter(chosen, lambda cut: cut <= F.col("turn"))), F.lit(0)))
    rows = rows.withColumn("piece", F.when(F.col("piece") > 0, F.col("piece")).otherwise(0).cast("int"))
    return rows, _begins(rows.filter(hashed.isin(list(cuts))).select("id", "piece", "turn", "role", "text"), template)


def _begins(rows: DataFrame, template: Template) -> dict:
    """The state in which each piece begins: the maps from state to state of the pieces before it, one after the other."""
    states = template.states
    known = {state: number for number, state in enumerate(states)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, leads = None, {}
        at: list[int] = []
        kind = None
        for batch in batches:
            kind = batch.schema.field("id").type
            for piece_of, role in zip(zip(batch.column("id").to_pylist(), batch.column("piece").to_pylist(), strict=True), batch.column("role").to_pylist(), strict=True):
                if piece_of != current:
                    if current is not None:
                        yield _map_row(current, at, kind)
                    current, at = piece_of, list(range(len(states)))
                if role not in leads:
                    leads[role] = [known[template.step(state, role)[0]] for state in states]
                at = [leads[role][state] for state in at]
        if current is not None:
            yield _map_row(current, at, kind)

    schema = T.StructType([rows.schema["id"], T.StructField("piece", T.IntegerType()), T.StructField("leads", T.ArrayType(T.IntegerType()))])
    ordered = rows.repartition("id", "piece").sortWithinPartitions("id", "piece", "turn", "role", "text").select("id", "piece", "role")
    found = sorted(ordered.mapInArrow(run, schema).collect(), key=lambda row: (str(row["id"]), row["piece"]))
    begins, state, of = {}, 0, object()
    for row in found:
        if row["id"] != of:
            of, state = row["id"], known[template.start]
        begins[row["id"], row["piece"]] = states[state]
        state = row["leads"][state]
    return begins


def _map_row(piece_of: tuple, leads: list[int], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([piece_of[0]], kind), pa.array([piece_of[1]], pa.int32()), pa.array([leads], pa.list_(pa.int32()))], names=["id", "piece", "leads"])


def read_back(formatted: DataFrame, cut: list | None = None, template: Template = CHAT, id_col: str = "conv_id") -> DataFrame:
    """What formatted turns say: one row per conversation, with digests of its turns and of all text under the loss mask, taken
    from the segments alone.

    A digest is worked out from the first to the last turn, so the pieces of ``cut`` conversations are brought together again, as
    a stream; all others are read where they are. Without ``cut`` nothing is known of the rows' order, and all are brought together.
    """
    kind = formatted.schema[id_col].dataType
    names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_not_allowed", "complete"]
    types = [T.LongType(), T.StringType(), T.LongType(), T.StringType(), T.LongType(), T.LongType(), T.BooleanType()]
    schema = T.StructType([T.StructField(id_col, kind), *[T.StructField(n, t) for n, t in zip(names, types, strict=True)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = object()
        current, seen = none, None
        for batch in batches:
            arrow, done = batch.schema.field(id_col).type, []
            columns = (batch.column(c).to_pylist() for c in (id_col, "segments", "state", "allowed"))
            for conversation, segments, state, allowed in zip(*columns, strict=True):
                if conversation != current or seen is None:
                    if seen is not None:
                        done.append((current, *seen.result(template)))
                    current, seen = conversation, _Seen()
                seen.add(segments, state, allowed, template)
            if done:
                yield _result(done, names, types, id_col, arrow)
        if seen is not None:
            yield _result([(current, *seen.result(template))], names, types, id_col, arrow)

    together = lambda rows: rows.repartition(id_col).sortWithinPartitions(id_col, "piece", "place").mapInArrow(run, schema)
    if cut is None:
        return together(formatted)
    if not cut:
        return formatted.mapInArrow(run, schema)
    of_cut = F.coalesce(F.col(id_col).isin([i for i in cut if i is not None]), F.lit(False))
    if None in cut:
        of_cut = of_cut | F.col(id_col).isNull()
    return formatted.filter(~of_cut).mapInArrow(run, schema).unionAll(together(formatted.filter(of_cut)))


class _Seen:
    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = self.bad = 0
        self.state = ""

    def add(self, segments: list[dict], state: str, allowed: bool, template: Template) -> None:
        for role, text in template.turns("".join(s["text"] for s in segments)):
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n += 1
        for segment in segments:
            self.chars += len(segment["text"])
            if segment["loss"]:
                text = original(segment["text"])
                self.loss.update(text.encode())
                self.loss_chars += len(text)
        self.bad += not allowed
        self.state = state

    def result(self, template: Template) -> tuple:
        return self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.bad, self.bad == 0 and self.state in template.ends


def _result(rows: list[tuple], names: list[str], types: list[T.DataType], id_col: str, kind: pa.DataType) -> pa.RecordBatch:
    arrow = {"bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(columns[0], kind), *[pa.array(c, arrow[t.simpleString()]) for c, t in zip(columns[1:], types, strict=True)]], names=[id_col, *names])

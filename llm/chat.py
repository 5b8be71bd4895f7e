"""Chat formatting: a finite-state machine over roles, a declarative template, per-segment loss flags.

All of it is Spark SQL.  A conversation is ordered by (turn, role, text), so ties and repeated rows have a defined
place.  Null texts are empty, a null role is the empty role.  The machine reads one role per turn; a turn whose role
has no transition from the state before it marks the conversation invalid (``first_bad`` is its place, from 0), and
the conversation is still formatted whole.  Empty tables give empty results; columns besides the four are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """How a turn is written: ``<open>role<mid>text<close>``.

    ``escapes`` maps each character that may start a control string, and the escape character itself first, to the
    code that follows the escape character.  No control string survives inside an escaped text or role.
    ``moves`` lists the allowed (state, role) pairs with the state that follows; ``accept`` the states to end in.
    """

    open: str = "<|"
    mid: str = "|>\n"
    close: str = "<|/|>\n"
    escape: str = "\\"
    escapes: tuple[tuple[str, str], ...] = (("\\", "0"), ("<", "1"), ("|", "2"), ("[", "3"))
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    moves: dict[tuple[str, str], str] = field(default_factory=lambda: {
        ("start", "system"): "ready", ("start", "user"): "asked", ("ready", "user"): "asked",
        ("asked", "assistant"): "answered", ("answered", "user"): "asked",
    })
    accept: tuple[str, ...] = ("asked", "answered")


DEFAULT = Template()


def escaped(text: Column, t: Template = DEFAULT) -> Column:
    for char, code in t.escapes:
        text = F.replace(text, F.lit(char), F.lit(t.escape + code))
    return text


def unescaped(text: Column, t: Template = DEFAULT) -> Column:
    """Inverse of ``escaped``: every escape character starts a pair, so the pairs may be replaced in turn, its own last."""
    for char, code in reversed(t.escapes):
        text = F.replace(text, F.lit(t.escape + code), F.lit(char))
    return text


def _state(roles: Column, t: Template) -> Column:
    """Run the machine over the roles: a struct of the state (empty once refused) and the place of the refusal."""
    zero = F.struct(F.lit(t.start).alias("state"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("bad"))

    def step(acc, role):
        nxt = F.lit("")
        for (state, name), to in t.moves.items():
            nxt = F.when((acc["state"] == state) & (role == name), to).otherwise(nxt)
        return F.struct(nxt.alias("state"), (acc["at"] + 1).alias("at"), F.coalesce(acc["bad"], F.when(nxt == "", acc["at"])).alias("bad"))

    return F.aggregate(roles, zero, step)


def format_chats(turns: DataFrame, t: Template = DEFAULT) -> DataFrame:
    """One row per conversation: conv_id, n_turns, valid, first_bad, segments, formatted.

    ``segments`` is array<struct<text, loss>> in order, three for a turn (opening, text, closing); only the text of a
    turn of a loss role carries the flag.  ``formatted`` joins their texts.
    """
    rows = turns.select("conv_id", F.struct(
        F.col("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).alias("t"))
    chats = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    parts = F.flatten(F.transform("turns", lambda r: F.array(
        F.struct(F.concat(F.lit(t.open), escaped(r["role"], t), F.lit(t.mid)).alias("text"), F.lit(False).alias("loss")),
        F.struct(escaped(r["text"], t).alias("text"), r["role"].isin(*t.loss_roles).alias("loss")),
        F.struct(F.lit(t.close).alias("text"), F.lit(False).alias("loss")),
    )))
    machine = _state(F.transform("turns", lambda r: r["role"]), t)
    return (
        chats.select("conv_id", F.size("turns").cast("long").alias("n_turns"), machine.alias("m"), parts.alias("segments"))
        .select(
            "conv_id", "n_turns", (F.col("m.bad").isNull() & F.col("m.state").isin(*t.accept)).alias("valid"),
            F.col("m.bad").alias("first_bad"), "segments", F.array_join(F.col("segments.text"), "").alias("formatted"),
        )
    )


def read_back(formatted: Column, t: Template = DEFAULT) -> Column:
    """array<struct<role, text>> of a formatted conversation, unescaped; linear in its length."""
    turns = F.split(formatted, F.lit(_quoted(t.close)))
    turns = F.slice(turns, 1, F.greatest(F.size(turns) - 1, F.lit(0)))
    halves = F.transform(turns, lambda x: F.split(x, F.lit(_quoted(t.mid)), 2))
    return F.transform(halves, lambda h: F.struct(
        unescaped(h[0].substr(F.lit(len(t.open) + 1), F.length(h[0])), t).alias("role"),
        unescaped(h[1], t).alias("text"),
    ))


def _quoted(s: str) -> str:
    return "".join("\\" + c if c in r"\.[]{}()*+-?^$|<>/" else c for c in s)

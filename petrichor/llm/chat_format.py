"""Chat formatting that is read back and escaped until the turns come out as they went in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
_CONTROL = r"\|(im_start|im_end)\|>"


def escaped(text: Column) -> Column:
    """One backslash more behind the ``<`` of whatever looks like a control string, escaped or not."""
    return F.regexp_replace(text, r"<(\\*)" + _CONTROL, r"<\\$1|$2|>")


def unescaped(text: Column) -> Column:
    """Undoes :func:`escaped`; a text without escapes stays as it is."""
    return F.regexp_replace(text, r"<\\(\\*)" + _CONTROL, r"<$1|$2|>")


def _role_escaped(role: Column) -> Column:
    return F.replace(F.replace(escaped(role), F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))


def _role_unescaped(role: Column) -> Column:
    return unescaped(F.replace(F.replace(role, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%")))


def _rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit("\n"), text, F.lit(CLOSE), F.lit("\n"))


def parsed(formatted: Column) -> Column:
    """The turns (role, text) that a formatted conversation holds; null if it breaks the grammar.

    conversation = turn*; turn = OPEN role newline text CLOSE newline; neither control string
    occurs elsewhere.
    """
    parts = F.split(formatted, r"<\|im_end\|>", -1)
    bodies = F.transform(
        F.slice(parts, F.lit(1), F.size(parts) - 1),
        lambda part, i: F.when(i == 0, part).when(part.startswith("\n"), F.substr(part, F.lit(2))),
    )
    turns = F.filter(bodies, lambda body: body.startswith(OPEN) & body.contains("\n") & (F.instr(F.substr(body, F.lit(2)), OPEN) == 0))
    head = len(OPEN)
    read = F.transform(
        turns,
        lambda body: F.struct(
            _role_unescaped(F.substr(body, F.lit(head + 1), F.locate("\n", body) - 1 - head)).alias("role"),
            unescaped(F.substr(body, F.locate("\n", body) + 1)).alias("text"),
        ),
    )
    whole = (F.element_at(parts, -1) == "\n") & (F.size(turns) == F.size(parts) - 1)
    return F.when(whole, read)


def format_chats(
    chats: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", loss_role: str = "assistant"
) -> DataFrame:
    """conv_id, formatted, loss_spans (start and length in code points, from 0), escaped, identical.

    Each conversation is rendered plainly and parsed again. Where the turns that come out are not
    those that went in, its texts and roles are rendered escaped and parsed once more; escaping
    leaves no control string, so the second reading is identical, and ``identical`` says so. The
    spans cover the texts of ``loss_role`` as they stand in ``formatted``.

    Turns are ordered by turn, role and text, a null turn first. A null text or role is empty, a
    null id is a conversation of its own. Repeated rows are repeated turns. Other columns are not
    read. An empty table gives no rows.
    """
    rows = chats.select(
        chats[id].cast("long").alias("conv_id"),
        chats[turn].cast("long").alias("turn"),
        F.coalesce(chats[role].cast("string"), F.lit("")).alias("role"),
        F.coalesce(chats[text].cast("string"), F.lit("")).alias("text"),
    )
    rows = rows.withColumns({
        "plain": _rendered(F.col("role"), F.col("text")),
        "safe": _rendered(_role_escaped(F.col("role")), escaped(F.col("text"))),
    })
    before = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)

    def span(rendered: str, role: Column, text: Column) -> Column:
        start = F.coalesce(F.sum(F.length(rendered)).over(before), F.lit(0)) + len(OPEN) + F.length(role) + 1
        return F.struct(start.cast("long").alias("start"), F.length(text).cast("long").alias("length"))

    rows = rows.withColumns({
        "plain_span": span("plain", F.col("role"), F.col("text")),
        "safe_span": span("safe", _role_escaped(F.col("role")), escaped(F.col("text"))),
    })
    held = F.sort_array(F.collect_list(F.struct("turn", "role", "text", "plain", "safe", "plain_span", "safe_span")))
    chats = rows.groupBy("conv_id").agg(held.alias("turns"))
    source = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    chats = chats.withColumn("plain", F.array_join(F.transform("turns", lambda t: t["plain"]), ""))
    chats = chats.withColumn("escaped", ~F.coalesce(parsed(F.col("plain")) == source, F.lit(False)))
    safe = F.array_join(F.transform("turns", lambda t: t["safe"]), "")
    chats = chats.withColumn("formatted", F.when(F.col("escaped"), safe).otherwise(F.col("plain")))
    spans = F.transform(
        F.filter("turns", lambda t: t["role"] == loss_role),
        lambda t: F.when(F.col("escaped"), t["safe_span"]).otherwise(t["plain_span"]),
    )
    identical = F.when(~F.col("escaped"), F.lit(True)).otherwise(F.coalesce(parsed(F.col("formatted")) == source, F.lit(False)))
    return chats.select("conv_id", "formatted", spans.alias("loss_spans"), "escaped", identical.alias("identical"))


def loss_text(formatted: Column, spans: Column) -> Column:
    """The text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescaped(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")

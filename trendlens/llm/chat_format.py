"""Chat formatting of typed content parts, on DataFrame functions only.

A turn is a role and a list of parts (type, text, ref, units). The visitor
handles each part by its type: text is escaped and written, an image, audio or
document part becomes a placeholder, is recorded as an attachment, and counts
for ``units`` times the tokens its type expands to. Turns are written as

    <turn ROLE>\\nBODY</turn>\\n

In roles and texts ``&`` and ``<`` (and in roles ``>``) are written as entities,
so no text can open or close a turn or look like a placeholder, and reading
back is exact. The loss mask lists the assistant bodies as code point spans.

Rows are written before they are shuffled; only the finished turns of one
conversation meet, since they make one output row. Defined cases: null text,
role or part list is empty, an unknown part type is text, turns sort by turn
(null first), then role and text; repeated rows are repeated turns; an empty
table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PARTS = "array<struct<type: string, text: string, ref: string, units: long>>"
#: Tokens that one unit of an attachment expands to (image tiles, audio seconds, document pages).
EXPANSION = {"image": 256, "audio": 25, "document": 512}
OPEN, HEAD, CLOSE = "<turn ", ">\n", "</turn>\n"


def escaped(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescaped(text: Column) -> Column:
    text = F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&gt;"), F.lit(">"))
    return F.replace(text, F.lit("&amp;"), F.lit("&"))


def text_parts(text: Column) -> Column:
    """A plain text as a part list."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(0).cast("long").alias("units")))


def _by_type(part: Column, attachment, text: Column) -> Column:
    """The visitor: what a part gives, by its type."""
    out = None
    for kind, tokens in EXPANSION.items():
        hit = part["type"] == kind
        value = attachment(kind, F.coalesce(part["units"], F.lit(0)) * tokens)
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out.otherwise(text)


def format_chats(messages: DataFrame) -> DataFrame:
    """Format (conv_id, turn, role, parts) rows.

    Returns conv_id, n_turns, formatted, loss_spans (start, length in code
    points), attachments (turn number, type, ref, tokens; in reading order) and
    n_tokens (words of the texts plus the attachments' expanded tokens).
    """
    parts = F.coalesce(F.col("parts"), F.array().cast(PARTS))
    body = F.array_join(F.transform(parts, lambda p: _by_type(p, lambda kind, _: F.lit(f"<{kind}/>"), escaped(p["text"]))), "")
    words = lambda p: F.regexp_count(F.coalesce(p["text"], F.lit("")), F.lit(r"\S+"))
    tokens = F.aggregate(parts, F.lit(0).cast("long"), lambda n, p: n + _by_type(p, lambda _, t: t, words(p).cast("long")))
    files = F.transform(
        F.filter(parts, lambda p: p["type"].isin(*EXPANSION)),
        lambda p: F.struct(p["type"].alias("type"), p["ref"].alias("ref"), _by_type(p, lambda _, t: t, F.lit(0).cast("long")).alias("tokens")),
    )
    role = F.coalesce(F.col("role"), F.lit(""))
    rows = messages.select(
        "conv_id", "turn", role.alias("role"), body.alias("body"), tokens.alias("tokens"), files.alias("files"),
        F.concat(F.lit(OPEN), F.replace(escaped(role), F.lit(">"), F.lit("&gt;")), F.lit(HEAD)).alias("head"),
    )
    rows = rows.withColumn("written", F.concat("head", "body", F.lit(CLOSE)))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "body")
    rows = rows.withColumn("n", F.row_number().over(order)).withColumn("end", F.sum(F.length("written")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    start = F.col("end") - F.length("written") + F.length("head")
    turn = F.struct(
        "n", "written", "tokens", "files",
        F.when(F.col("role") == "assistant", F.struct(start.alias("start"), F.length("body").cast("long").alias("length"))).alias("span"),
    )
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    listed = F.flatten(F.transform("turns", lambda t: F.transform(t["files"], lambda f: F.struct(t["n"].alias("turn"), f["type"].alias("type"), f["ref"].alias("ref"), f["tokens"].alias("tokens")))))
    return turns.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.col("turns.written"), "").alias("formatted"),
        F.filter(F.col("turns.span"), lambda s: s.isNotNull()).alias("loss_spans"),
        listed.alias("attachments"),
        F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + t["tokens"]).alias("n_tokens"),
    )


def _text(body: Column) -> Column:
    return unescaped(F.regexp_replace(body, f"<({'|'.join(EXPANSION)})/>", ""))


def read_turns(formatted: Column) -> Column:
    """The (role, text) turns of a formatted conversation; placeholders are left out of the texts."""
    chunks = F.split(formatted, CLOSE)
    chunks = F.slice(chunks, F.lit(1), F.size(chunks) - 1)

    def turn(c: Column) -> Column:
        at = F.locate(HEAD, c)
        return F.struct(unescaped(c.substr(F.lit(len(OPEN) + 1), at - len(OPEN) - 1)).alias("role"), _text(c.substr(at + len(HEAD), F.length(c))).alias("text"))

    return F.transform(chunks, turn)


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask."""
    return F.array_join(F.transform(spans, lambda s: _text(formatted.substr((s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


ORACLE = r"""WITH m AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, replace(replace(text, '&', '&amp;'), '<', '&lt;') AS body, replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS head FROM m)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, body)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, body) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(16 + length(head) + length(body)) AS BIGINT) AS formatted_chars FROM e GROUP BY conv_id"""

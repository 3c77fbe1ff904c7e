"""Chat formatting as relations, with DataFrame functions only.

A conversation's turns are collected as structs and sorted; adjacent turns of one role share a
header, and the pieces are concatenated::

    ### Role: first text<+>second text</turn>
    ### Other: text</turn>

Inside roles and texts a backslash becomes ``\\b`` and each control string a code of its own, so an
escaped text holds no control string and what was written is read back exactly. The loss mask is
kept as runs of characters: those of the trained role's texts are in it, nothing else is.

Turns are gathered in two steps, first by ranges of turn numbers and then by conversation.

Defined cases: null text or role is the empty string; a null turn number sorts last; ties sort by
role, then text; rows of a null conversation id form one conversation; repeated rows are turns like
others; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table

HEAD, COLON, JOIN, END = "### ", ": ", "<+>", "</turn>"
#: What stands in texts for the escape sign and the control strings; the escape sign is first.
CODES = (("\\", "\\b"), (HEAD, "\\h"), (END, "\\e"), (JOIN, "\\j"))
TURN_RANGE, TRAINED = 64, "assistant"


def escape(text: Column, codes=CODES) -> Column:
    for plain, code in codes:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column, codes=CODES) -> Column:
    """Every backslash of an escaped text begins a code, so the codes can be replaced one after another, the sign itself last."""
    for plain, code in reversed(codes):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


_ROLE_CODES = (*CODES, (COLON, "\\c"))


def collect_turns(rows: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """conv_id, turns: the sorted turns of each conversation."""
    turn = F.col(turn_col).cast("long")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    one = F.struct(turn.isNull().alias("last"), turn.alias("turn"), role.alias("role"), text.alias("text"))
    rows = rows.select(F.col(conv_col).cast("long").alias("conv_id"), F.floor(turn / TURN_RANGE).alias("range"), one.alias("one"))
    parts = rows.groupBy("conv_id", "range").agg(F.array_sort(F.collect_list("one")).alias("turns"))
    part = F.struct(F.col("range").isNull().alias("last"), "range", "turns")
    parts = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    turns = F.flatten(F.transform("parts", lambda p: p["turns"]))
    return parts.select("conv_id", F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def format_turns(convs: DataFrame, trained: str = TRAINED) -> DataFrame:
    """conv_id, formatted, loss_runs: the text and its loss mask as (chars, in_loss) runs in order."""

    def pieces(t: Column, i: Column) -> Column:
        goes_on = (i > 0) & (F.get("turns", i - 1)["role"] == t["role"])
        head = F.concat(F.when(i > 0, END + "\n").otherwise(""), F.lit(HEAD), escape(t["role"], _ROLE_CODES), F.lit(COLON))
        lead = F.when(goes_on, F.lit(JOIN)).otherwise(head)
        return F.struct(lead.alias("lead"), escape(t["text"]).alias("text"), (t["role"] == trained).alias("loss"))

    made = convs.withColumn("pieces", F.transform("turns", pieces))
    runs = F.flatten(F.transform("pieces", lambda p: F.array(
        F.struct(F.length(p["lead"]).alias("chars"), F.lit(False).alias("in_loss")),
        F.struct(F.length(p["text"]).alias("chars"), p["loss"].alias("in_loss")),
    )))
    end = F.array(F.struct(F.lit(len(END) + 1).alias("chars"), F.lit(False).alias("in_loss")))
    text = F.concat(F.array_join(F.transform("pieces", lambda p: F.concat(p["lead"], p["text"])), ""), F.lit(END + "\n"))
    return made.select("conv_id", text.alias("formatted"), F.concat(runs, end).alias("loss_runs"))


def parse_formatted(formatted: DataFrame) -> DataFrame:
    """Adds turns, read back from the formatted text alone."""
    blocks = F.filter(F.split("formatted", END + "\n"), lambda b: b != "")
    header = F.transform(blocks, lambda b: F.substring_index(b, COLON, 1))
    both = F.arrays_zip(blocks.alias("block"), header.alias("header"))

    def turns(x: Column) -> Column:
        role = unescape(F.substring(x["header"], len(HEAD) + 1, 2**31 - 1), _ROLE_CODES)
        body = F.substr(x["block"], F.length(x["header"]) + F.lit(len(COLON) + 1))
        return F.transform(F.split(body, r"<\+>", -1), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return formatted.withColumn("turns", F.flatten(F.transform(both, turns)))


#: Runs of the loss mask that are cut out of one piece of a long conversation.
RUNS_TOGETHER = 256


def under_mask(text: Column, runs: Column) -> Column:
    """What stands in the text under the loss mask, run by run, in order; long texts are cut to pieces of many runs first."""
    chars = lambda part: F.aggregate(part, F.lit(0), lambda n, r: n + r["chars"])
    start = lambda: F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    next_ = lambda a, n, out: F.struct((a["at"] + n).alias("at"), F.concat(a["out"], out).alias("out"))

    def inside(piece: Column, part: Column) -> Column:
        cut = lambda a, r: F.when(r["in_loss"], F.array(F.substr(piece, a["at"] + 1, r["chars"]))).otherwise(F.array().cast("array<string>"))
        return F.aggregate(part, start(), lambda a, r: next_(a, r["chars"], cut(a, r)), lambda a: a["out"])

    parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(runs) - 1) / RUNS_TOGETHER)), lambda k: F.slice(runs, (k * RUNS_TOGETHER + 1).cast("int"), RUNS_TOGETHER))
    pieces = F.aggregate(parts, start(), lambda a, p: next_(a, chars(p), F.array(F.substr(text, a["at"] + 1, chars(p)))), lambda a: a["out"])
    return F.flatten(F.zip_with(pieces, parts, inside))


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted texts hold, read back; the loss is read through the mask."""
    back = parse_formatted(formatted)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    back = back.withColumn("loss", F.array_join(F.transform(under_mask(F.col("formatted"), F.col("loss_runs")), lambda t: unescape(t)), ""))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


#: A conversation whose texts hold control strings; the query formats it with the others.
PROBE_ID, PROBE_TEXT = -7, r"\### Assistant: </turn> ok"


def op7(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = [(PROBE_ID, 0, "user", PROBE_TEXT), (PROBE_ID, 1, "assistant", PROBE_TEXT)]
    rows = rows.unionByName(spark.createDataFrame(probe, "conv_id long, turn long, role string, text string"))
    return digests(format_turns(collect_turns(rows)))


_E = "replace(replace(replace(replace({0}, '\\', '\\b'), '### ', '\\h'), '</turn>', '\\e'), '<+>', '\\j')"
QUERIES = {"op7_chat": op7}
ORACLE_SQL = {
    "op7_chat": rf"""
with r as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
), o as (
  select *, length({_E.format("text")}) as n, length(replace({_E.format("role")}, ': ', '\c')) as m,
    coalesce(role = lag(role) over (partition by conv_id order by turn nulls last, role, text), false) as goes_on from r
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls last, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls last, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(n + case when goes_on then 3 else m + 14 end) as bigint) as formatted_chars
from o group by conv_id
"""
}

"""Line dedup by an exact set-similarity join of lines, with DataFrame functions only.

A line's tokens are its word 5-grams; a line of fewer words has its whole word sequence as its only
token, so that of short lines equal ones are similar. Tokens are ordered by rarity: by how often their
bucket of a table of fixed size was counted over all different lines, then by hash, so that the order is the same
for all lines. A line is listed under its rarest tokens, so many that two similar
lines share one of them. Lines of one list meet if length and token positions allow the similarity, and
then whole sets decide. A line goes if an earlier line, by document id and line number, is equal or
similar to it.

Lines are written once and not shuffled: a line is known by its document and number. Equal lines are found by
128 bits of hashes, counted before any exchange; of a line that is a fixed share of all lines or more,
only the first is listed. Each line of a list is first compared with the list's earliest; only lines
that stay are compared with all earlier ones, where sketches of both leave enough in common.

Defined cases: lines without words always stay and remove nothing; null or empty text stays as it is;
rows without id keep their lines and remove nothing; rows that repeat an id, a line number and the line
are one line, and other lines of a repeated id and number are judged together; very long lines are
compared whole; an empty table gives an empty result; other columns, whatever their names, are kept by
``clean_documents``, but n_lines and n_removed where it is to count.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, discard, materialize, release, table

WORDS, NUM, DEN = 5, 80, 100
#: Buckets of the rarity table; 64-bit words of the filter that tells which lines have candidates, at least and at most; a line that is more than such a part of all lines is listed once.
RARITY_BUCKETS, FILTER_WORDS, MOST_FILTER_WORDS, HOT_PART = 1 << 14, 1 << 15, 1 << 21, 4096
#: Steps of a rarity level in a doubling of the count.
STEPS = 8
#: 64-bit words of a line's bit sketch: a bit that one line has and another lacks proves a token outside the intersection.
SKETCH = [f"s{k}" for k in range(4)]
_ODD_SPACES = ("  ", "\t", "\x0b", "\x0c", "\r")


def _spaced(line: Column) -> Column:
    """The line's words with single spaces between; the regular expression is for lines that need it only."""
    odd = F.startswith(line, F.lit(" ")) | F.endswith(line, F.lit(" "))
    for space in _ODD_SPACES:
        odd = odd | F.contains(line, F.lit(space))
    return F.when(odd, F.btrim(F.regexp_replace(line, f"[{SPACE}]+", " "))).otherwise(line)


def _key(line: Column) -> tuple[Column, Column]:
    return F.xxhash64(line).alias("k1"), F.xxhash64(F.lit(7), line).alias("k2")


def with_hashes(rows: DataFrame) -> DataFrame:
    """Adds hashes of the tokens to rows with words w, in place of these.

    Hashes of five words are made of those of three pairs among them. The pairs are a column of their own:
    within a lambda, an expression would be worked out anew for each element.
    """
    size = F.size("w")
    rows = rows.withColumn("_two", F.zip_with("w", F.slice("w", 2, size), lambda x, y: F.xxhash64(x, y)))
    five = F.transform("_two", lambda x, i: F.xxhash64(x, F.get("_two", i + 2), F.get("_two", i + 3)))
    return rows.withColumn("hashes", F.slice(five, 1, F.greatest(size - (WORDS - 1), F.lit(1)))).drop("w", "_two")


def with_tokens(rows: DataFrame, rarity: Column) -> DataFrame:
    """Adds tokens to rows with words w, in place of these: the distinct ones as longs in order, of which the high bits are the rarity as the table has it, the others a hash."""
    # Arrays that can't hold nulls are sorted as longs, not as objects.
    level = lambda h: F.coalesce(F.get(rarity, h.bitwiseAND(RARITY_BUCKETS - 1).cast("int")), F.lit(0).cast("long"))
    key = lambda h: level(h).bitwiseOR(F.shiftrightunsigned(h, 10))
    return with_hashes(rows).withColumn("tokens", F.sort_array(F.array_distinct(F.transform("hashes", key)))).drop("hashes")


def _dense(counts: DataFrame, size: int, key: str, value: str) -> Column:
    """A table of fixed size as one array, a constant of the query that uses it."""
    every = counts.sparkSession.range(size).withColumnRenamed("id", key).join(counts, key, "left")
    pairs = F.sort_array(F.collect_list(F.struct(F.col(key), F.coalesce(value, F.lit(0)).alias("x"))))
    return every.agg(F.transform(pairs, lambda p: p["x"]).alias("x")).scalar()


def id_filter(ids: DataFrame, words: int = FILTER_WORDS) -> Column:
    """A bit table of fixed size of the ids (one long column); ids that it has not are surely not there."""
    bit = F.pmod(F.xxhash64(ids.columns[0]), F.lit(words * 64))
    bits = ids.select(F.floor(bit / 64).alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(bit, F.lit(64)).cast("int")).alias("b"))
    return _dense(bits.groupBy("w").agg(F.bit_or("b").alias("b")), words, "w", "b")


def may_hold(bits: Column, id_: Column, words: int = FILTER_WORDS) -> Column:
    bit = F.pmod(F.xxhash64(id_), F.lit(words * 64))
    return F.getbit(F.get(bits, F.floor(bit / 64).cast("int")), F.pmod(bit, F.lit(64)).cast("int")) == 1


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, no, line: every line that has words, with single spaces between them."""
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    rows = rows.select("doc_id", F.posexplode(F.split("t", "\n")).alias("no", "raw")).where(F.length("raw") > 0)
    return rows.select("doc_id", "no", _spaced(F.col("raw")).alias("line")).where(F.length("line") > 0)


def equal_lines(lines: DataFrame) -> tuple[DataFrame, int]:
    """Of lines that occur several times: k1, k2, their first place d, m, and c, how often; and the number of all lines."""
    keys = lines.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "no")).alias("f"), F.count("*").alias("c"))
    out = materialize(keys.where("c > 1").select("k1", "k2", F.col("f.doc_id").alias("d"), F.col("f.no").alias("m"), "c"), "line-equal")
    return out, lines.count()  # of stored lines their files' footers tell the number


def _words(lines: DataFrame) -> DataFrame:
    """Words w in place of the line; lines are stored whole, since one string is written and read faster than its words."""
    return lines.withColumn("w", F.split("line", " ")).drop("line")


def rarity_table(lines: DataFrame) -> Column:
    """The rarity levels of the buckets of tokens, in the high bits of longs; a constant of fixed size. Lines are unfolded, so that hashing and counting are compiled together."""
    words, gram = F.col("w"), lambda k: F.get("w", F.col("i") + k)
    each = lines.select("w", F.explode(F.sequence(F.lit(0), F.greatest(F.size(words) - WORDS, F.lit(0)))).alias("i"))
    token = F.xxhash64(F.xxhash64(gram(0), gram(1)), F.xxhash64(gram(2), gram(3)), F.xxhash64(gram(3), gram(4)))
    levels = {r[0]: r[1] for r in each.groupBy(token.bitwiseAND(RARITY_BUCKETS - 1).alias("b")).agg(F.ceil(STEPS * F.log2(F.count("*") + 1)).cast("int")).collect()}
    return F.from_json(F.lit(json.dumps([levels.get(b, 0) << 54 for b in range(RARITY_BUCKETS)])), "array<bigint>")


def _reach(num: int, den: int, n: Column, pos: Column) -> tuple[Column, Column]:
    """Smallest and largest size of a line similar to one of size n, the token at pos being the first common one."""
    most = F.least(F.floor(F.lit(den) * n / F.lit(float(num)) + 1e-9), F.floor((n - pos) * F.lit(num + den) / F.lit(float(num)) + 1e-9) - n)
    return F.ceil(F.lit(num) * n / F.lit(float(den)) - 1e-9), most


_LINE, _TO = ["doc_id", "no"], ["to_id", "to_no"]


def similar_lines(lines: DataFrame, equal: DataFrame, copies: DataFrame, n_lines: int, num: int = NUM, den: int = DEN) -> DataFrame:
    """doc_id, no, k1 of the lines that are similar to an earlier one, those equal to an earlier one aside."""
    # A line listed once at most: there are fewer than HOT_PART such keys.
    hot = F.broadcast(equal.where(F.col("c") > max(HOT_PART, n_lines) / HOT_PART).select("k1", "k2", "d", "m"))
    once = _without(lines, copies).join(hot, ["k1", "k2"], "left").where("d is null or (d = doc_id and m = no)")
    rarity = rarity_table(_words(once.select("line")))
    worded = with_tokens(_words(once.select(*_LINE, "line")), rarity)
    n = F.size("tokens")
    prefix = F.slice("tokens", 1, _prefix(n, num, den))
    listed = worded.select(*_LINE, n.alias("n"), F.posexplode(prefix).alias("pos", "token"))
    low, high = (c.alias(name) for c, name in zip(_reach(num, den, F.col("n"), F.col("pos")), ("low", "high"), strict=True))
    # Of two similar lines the smaller one stands early enough in the list; lists without such a one, or of one line, are done.
    in_list = Window.partitionBy("token")
    listed = listed.withColumns({"many": F.count("*").over(in_list), "early": F.max((high >= F.col("n")).cast("int")).over(in_list)})
    listed = listed.where("many > 1 and early = 1")
    # Windows over one key need one exchange. The earliest line of a list is no copy, since the line that it equals would be in the list too.
    listed = listed.withColumn("lead", F.min(F.struct(*_LINE, "n", "pos")).over(in_list)).drop("early")
    entries = materialize(listed.select("token", *_LINE, "n", "pos", "many", "lead", low, high), "line-entries")
    release(lines.sparkSession)
    tried, longer = _with_lead(entries, num, den), entries.where("many > 2").drop("many", "lead")
    tried = materialize(tried, "line-tried")
    places = tried.select(*_LINE).union(tried.select(*_TO)).union(longer.select(*_LINE)).distinct()
    sets = _sets(lines, places)
    led = _decided(tried, sets, num, den)
    gone = led.where("similar").select(*_LINE).distinct()
    # Lines that stay so far with all earlier ones of their lists; a list of two has no other pair.
    longer = longer.join(_chosen(sets, longer).select(*_LINE, *_sketch("set")), _LINE)
    left, right = longer.join(gone, _LINE, "left_anti").alias("l"), longer.alias("r")
    near = F.col("l.n").between(F.col("r.low"), F.col("r.high")) & F.col("r.n").between(F.col("l.low"), F.col("l.high"))
    lost = lambda a, b: sum((F.bit_count(F.col(f"{a}.{s}").bitwiseAND(F.bitwise_not(f"{b}.{s}"))) for s in SKETCH), F.lit(0))
    need = _need(F.col("l.n"), F.col("r.n"), num, den)
    near = near & (F.col("l.n") - lost("l", "r") >= need) & (F.col("r.n") - lost("r", "l") >= need)
    rest = left.join(right, "token").where(F.struct("l.doc_id", "l.no") > F.struct("r.doc_id", "r.no")).where(near)
    rest = rest.select("l.doc_id", "l.no", F.col("r.doc_id").alias("to_id"), F.col("r.no").alias("to_no")).distinct()
    rest = materialize(rest.join(tried, _LINE + _TO, "left_anti"), "line-rest")
    late = _decided(rest, sets, num, den)
    found = gone.union(late.where("similar").select(*_LINE)).distinct()
    # The few copies that the bit filter left are found elsewhere.
    found = materialize(found.join(copies.select(*_LINE), _LINE, "left_anti"), "line-found")
    near = materialize(_chosen(sets, found).select(*_LINE, "k1").join(found, _LINE, "left_semi"), "line-near")
    discard(entries, sets, tried, rest, led, late, found)
    return near


def _need(a: Column, b: Column, num: int, den: int) -> Column:
    """Least intersection of similar lines of sizes a and b."""
    return F.ceil(F.lit(num) * (a + b) / F.lit(float(num + den)) - 1e-9)


def _prefix(n: Column, num: int, den: int) -> Column:
    """So many of a line's first tokens are listed."""
    return (n + F.floor(-num * n / F.lit(float(den)) + 1e-9) + 1).cast("int")


def _with_lead(entries: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (doc_id, no, to_id, to_no) of lines with the earliest of their lists that can be similar."""
    low, high = _reach(num, den, F.col("lead.n"), F.col("lead.pos"))
    fits = F.col("lead.n").between(F.col("low"), F.col("high")) & F.col("n").between(low, high)
    pairs = entries.where(F.struct(*_LINE) > F.struct("lead.doc_id", "lead.no")).where(fits)
    return pairs.select(*_LINE, F.col("lead.doc_id").alias("to_id"), F.col("lead.no").alias("to_no")).distinct()


def _sketch(tokens: str) -> list[Column]:
    in_word = lambda k: F.filter(tokens, lambda t: F.shiftright(t, 6).bitwiseAND(len(SKETCH) - 1) == k)
    bit = lambda t: F.call_function("shiftleft", F.lit(1).cast("long"), t.bitwiseAND(63).cast("int"))
    return [F.aggregate(in_word(k), F.lit(0).cast("long"), lambda a, t: a.bitwiseOR(bit(t))).alias(s) for k, s in enumerate(SKETCH)]


def _chosen(rows: DataFrame, places: DataFrame) -> DataFrame:
    """The rows at the places (doc_id, no), and a few others: by a bit filter whose size follows the places' number, within bounds. It only spares rows an exchange."""
    place = F.xxhash64(*_LINE)
    words = 1 << max(0, places.count() // 4).bit_length()
    words = min(MOST_FILTER_WORDS, max(FILTER_WORDS, words))
    return rows.where(may_hold(id_filter(places.select(place.alias("id")), words), place, words))


def _without(lines: DataFrame, copies: DataFrame) -> DataFrame:
    """The lines without the copies, but for a few of these: by a bit filter of the copies and one of the others that it holds by chance. No line is exchanged."""
    place = F.xxhash64(*_LINE)
    words = min(MOST_FILTER_WORDS, max(FILTER_WORDS, 1 << max(0, copies.count() // 2).bit_length()))
    bits = id_filter(copies.select(place.alias("id")), words)
    spared = materialize(lines.select(*_LINE).where(may_hold(bits, place, words)).join(copies.select(*_LINE), _LINE, "left_anti"), "line-spared")
    again = id_filter(spared.select(place.alias("id")), words)
    return lines.where(~may_hold(bits, place, words) | may_hold(again, place, words))


def _sets(lines: DataFrame, places: DataFrame) -> DataFrame:
    """doc_id, no, k1, set of the lines at the places: distinct hashes of their tokens."""
    held = with_hashes(_words(_chosen(lines, places).select(*_LINE, "k1", "line")))
    return materialize(held.select(*_LINE, "k1", F.array_distinct("hashes").alias("set")), "line-sets")


def _decided(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (doc_id, no, to_id, to_no) with similar, by the whole sets of both lines."""
    sets = _chosen(sets, pairs.select(*_LINE).union(pairs.select(*_TO)))
    both = pairs.join(sets.select(*_LINE, F.col("set").alias("a")), _LINE).join(sets.select("doc_id", "no", "set").toDF(*_TO, "b"), _TO)
    inter = F.size(F.array_intersect("a", "b"))
    similar = den * inter >= num * (F.size("a") + F.size("b") - inter)
    return materialize(both.select(*_LINE, *_TO, similar.alias("similar")), "line-decided")


def removed_lines(docs: DataFrame, id_col="doc_id", text_col="text", num=NUM, den=DEN) -> DataFrame:
    """doc_id, no, k1: the places of lines that go."""
    lines = _lines(docs, id_col, text_col)
    lines = materialize(lines.select(*_LINE, *_key(F.col("line")), "line"), "lines")
    equal, n_lines = equal_lines(lines)
    copies = lines.select(*_LINE, "k1", "k2").join(equal, ["k1", "k2"]).where((F.col("doc_id") != F.col("d")) | (F.col("no") != F.col("m")))
    copies = materialize(copies.select(*_LINE, "k1"), "line-copies")
    near = similar_lines(lines, equal, copies, n_lines, num, den)
    discard(lines, equal)
    return copies.union(near.select(*_LINE, "k1"))


def clean_documents(docs: DataFrame, id_col="doc_id", text_col="text", num=NUM, den=DEN, counts: bool = False) -> DataFrame:
    """The documents without the lines that go; with counts, also n_lines and n_removed."""
    gone = removed_lines(docs, id_col, text_col, num, den).groupBy("doc_id").agg(F.collect_set(F.struct("no", "k1")).alias("gone"))
    # The documents' own columns stand in one struct, so that their names do not matter.
    rows = docs.select(F.col(id_col).cast("long").alias("key"), F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    rows = rows.join(gone, F.col("key") == F.col("doc_id"), "left").withColumn("lines", F.split(F.col("row")[text_col].cast("string"), "\n"))
    its = F.filter("gone", lambda g: F.xxhash64(_spaced(F.get("lines", g["no"]))) == g["k1"])
    rows = rows.withColumn("nos", F.transform(its, lambda g: g["no"]))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("nos"))
    text = F.when(F.coalesce(F.size("nos"), F.lit(0)) > 0, F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n")).otherwise(F.col("row")[text_col])
    rows = rows.withColumn("new", text)
    out = {c: F.col("row")[c] for c in docs.columns} | {text_col: F.col("new")}
    if "n_chars" in out:
        out["n_chars"] = F.length("new").cast("long")
    if counts:
        out |= {"n_lines": F.size("lines"), "n_removed": F.coalesce(F.size("nos"), F.lit(0))}
    return rows.select(*[c.alias(name) for name, c in out.items()])


def op8(spark, sf_dir: str) -> DataFrame:
    rows = clean_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), counts=True)
    return rows.select("doc_id", F.when(F.col("text").isNull(), 0).otherwise(F.col("n_lines")).alias("n_lines"), "n_removed", "text")


QUERIES = {"op8_line_dedup": op8}
ORACLE_SQL = {
    "op8_line_dedup": r"""
with l as (
  select doc_id, no, lines[no] as line from (select doc_id, lines, unnest(range(1, len(lines) + 1)) as no from (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents))
), w as (select *, regexp_extract_all(line, '[^\x20\x09-\x0D]+') as w from l),
f as (select *, row_number() over (partition by line order by doc_id, no) as copy from w where len(w) > 0),
u as (select *, row_number() over (order by doc_id, no) as k from f where copy = 1),
g as (select distinct k, array_to_string(list_slice(w, i, i + 4), ' ') as g from (select k, w, unnest(range(1, greatest(len(w) - 3, 2))) as i from u)),
n as (select k, count(*) as n from g group by k),
near as (select a.k from g a join g b on a.g = b.g and b.k < a.k join n s on s.k = a.k join n t on t.k = b.k group by a.k, b.k, s.n, t.n having 100 * count(*) >= 80 * (s.n + t.n - count(*))),
gone as (select doc_id, no from f where copy > 1 union select doc_id, no from u where k in (select k from near))
select l.doc_id, cast(case when any_value(d.text) is null then 0 else count(*) end as int) as n_lines, cast(count(gone.no) as int) as n_removed,
  case when any_value(d.text) is not null then coalesce(string_agg(l.line, chr(10) order by l.no) filter (where gone.no is null), '') end as text
from l join documents d on d.doc_id = l.doc_id left join gone on gone.doc_id = l.doc_id and gone.no = l.no group by l.doc_id
"""
}

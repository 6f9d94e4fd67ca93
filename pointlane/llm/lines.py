"""Line deduplication by a fixed-depth tree of line templates; DataFrame operations only.

A line is parsed like a log message. Tokens with a digit become ``<*>``, and
the line falls to the leaf given by its number of tokens and its leading
``depth`` tokens. In a leaf, a position of the distinct lines keeps its
token if the token's support there (the number of texts that hold a line with
it) is at least ``min_texts``, and becomes ``<*>`` otherwise; so fields that
vary are generalised. As absolute support grows with the input, ``shares`` adds
templates that keep a token only by its part of the leaf's support (a branching
limit at any size); a line is dropped if one of its templates recurs and an
earlier line holds it. The first line of all has none before it, so it stays.
A line whose share of kept positions is below ``similar``
is a template of its own.

A template recurs if at least ``min_texts`` different texts hold it. Every
occurrence of a recurring template is dropped but the first (the least doc_id,
then line number). Exact copies of a text count once, as they are no evidence
of boilerplate: whole-document duplicates are for the near-duplicate operators.
A line of at least ``long_tokens`` tokens is evidence enough as it stands: it
recurs literally (but for its numbers) from two different texts on.

Only lines whose leaf is shared by enough texts are split into tokens, and only
once for each distinct line, so the work on tokens is small beside the input.

Defined cases: lines of fewer than ``min_tokens`` tokens (blank ones too) are
never dropped; a null text stays null; a text that loses all its lines becomes
empty; a null doc_id sorts last, so it is first only if no other id holds the
template; rows that repeat id and text are treated alike; further columns pass
through, and an empty table stays one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import carried, named, stored, unpacked

DEPTH, MIN_TEXTS, MIN_TOKENS, SIMILAR, LONG_TOKENS = 3, 4, 3, 0.6, 50
#: Levels of generalisation: at a share s a position keeps 1 / s tokens at most, however many texts a leaf has.
SHARES = (0.0, 0.01, 0.1, 0.5)


def _flat(line):
    """The line with its tokens one space apart. Most lines are so already; substring searches tell without decoding the text."""
    loose = line.startswith(" ") | line.endswith(" ")
    for odd in ("  ", "\t", "\r", "\v", "\f"):
        loose |= F.contains(line, F.lit(odd))
    return F.when(loose, F.trim(F.regexp_replace(line, r"[\x20\x09-\x0D]+", " "))).otherwise(line)


def _masked(flat):
    """Tokens with a digit masked. A token is matched from its start only, so a line is read once."""
    return F.when(flat.rlike("[0-9]"), F.regexp_replace(flat, r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*+", "<*>")).otherwise(flat)


def occurrences(docs: DataFrame, depth: int = DEPTH, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """(doc_id, text_key, line_no, masked, form, leaf, tokens) of every line long enough to be a template.

    form is a hash of the masked line, leaf one of its number of tokens and leading tokens.
    """
    # Masked before the rows are made: a filter on lines would otherwise repeat the masking for each of its terms.
    parts = F.transform(F.transform(F.split("text", "\n"), _flat), _masked)
    rows = docs.where(F.col("text").isNotNull()).select("doc_id", F.xxhash64("text").alias("text_key"), F.posexplode(parts).alias("line_no", "masked"))
    n = F.octet_length("masked") - F.octet_length(F.replace(F.col("masked"), F.lit(" "), F.lit(""))) + 1
    rows = rows.where((n >= min_tokens) & (F.col("masked") != ""))
    return rows.select("doc_id", "text_key", "line_no", "masked", F.xxhash64("masked").alias("form"), F.xxhash64(n, F.substring_index("masked", " ", depth)).alias("leaf"), n.alias("tokens"))


def templates(lines: DataFrame, min_texts: int = MIN_TEXTS, similar: float = SIMILAR, shares: tuple[float, ...] = (0.0,)) -> DataFrame:
    """(leaf, form, template) of the distinct lines in leaves that enough texts share.

    ``lines`` has leaf, form, masked and support, the number of texts, of each distinct line.
    A line has a template for each of ``shares``, the least part of the leaf's support that a kept token has at its
    position; equal ones are one.
    """
    tokens = lines.select("leaf", "form", "support", F.posexplode(F.split("masked", " ")).alias("at", "token"))
    common = tokens.groupBy("leaf", "at", "token").agg(F.sum("support").alias("held")).where(F.col("held") >= min_texts)
    common = common.select(F.col("leaf").alias("l"), F.col("at").alias("a"), F.col("token").alias("t"), "held")
    kept = tokens.join(common, (F.col("leaf") == F.col("l")) & (F.col("at") == F.col("a")) & (F.col("token") == F.col("t")), "left")
    if any(shares):
        # All lines of a leaf have as many tokens, so one sum serves all positions.
        whole = lines.groupBy(F.col("leaf").alias("w")).agg(F.sum("support").alias("whole"))
        kept = kept.join(whole, F.col("leaf") == F.col("w"))
    keeps = [F.col("t").isNotNull() & (F.col("held") >= share * F.col("whole")) if share else F.col("t").isNotNull() for share in shares]
    fixed = [F.count_if(keep).alias(f"fixed{k}") for k, keep in enumerate(keeps)]
    marks = [F.sum(F.when(keep, F.xxhash64("at", "t")).otherwise(0).cast("decimal(20,0)")).alias(f"mark{k}") for k, keep in enumerate(keeps)]
    by_line = kept.groupBy("leaf", "form").agg(F.count("*").alias("n"), *fixed, *marks)
    each = [F.when(F.col(f"fixed{k}") >= similar * F.col("n"), F.xxhash64("leaf", "n", f"fixed{k}", f"mark{k}")).otherwise(F.col("form")) for k in range(len(shares))]
    return by_line.select("leaf", "form", F.explode(F.array_distinct(F.array(*each))).alias("template"))


def recurring(docs: DataFrame, depth: int = DEPTH, min_texts: int = MIN_TEXTS, min_tokens: int = MIN_TOKENS, similar: float = SIMILAR, shares: tuple[float, ...] = (0.0,), long_tokens: int | None = LONG_TOKENS) -> DataFrame:
    """(doc_id, text_key, line_no) of the occurrences to drop; with ``long_tokens`` None long lines are like others."""
    found = occurrences(docs, depth, min_tokens)
    slim = stored(found.select("doc_id", "text_key", "line_no", "form", "leaf", "tokens"), "lines")
    shared = slim.groupBy("leaf", "text_key").agg(F.lit(1).alias("one")).groupBy("leaf").agg(F.count("*").alias("texts")).where(F.col("texts") >= min_texts).select(F.col("leaf").alias("shared_leaf"))
    shared = stored(shared, "leaves")
    # Texts by distinct line, of the leaves that enough texts share.
    held = slim.join(shared, F.col("leaf") == F.col("shared_leaf")).select("leaf", "form", "text_key").distinct().groupBy("leaf", "form").agg(F.count("*").alias("support"))
    held = stored(held, "forms")
    words = found.select("form", "leaf", "masked").join(shared, F.col("leaf") == F.col("shared_leaf")).groupBy("leaf", "form").agg(F.first("masked").alias("masked"))
    words = words.select(F.col("leaf").alias("w_leaf"), F.col("form").alias("w_form"), "masked")
    lines = held.join(words, (F.col("leaf") == F.col("w_leaf")) & (F.col("form") == F.col("w_form"))).select("leaf", "form", "masked", "support")
    # Lines and templates are told apart by two hashes, of leaf and form: 64 bits alone would join unlike lines of very large inputs.
    of_form = stored(templates(lines, min_texts, similar, shares).select(F.col("leaf").alias("of_leaf"), F.col("form").alias("of_form"), "template"), "templates")
    marked = slim.join(of_form, (F.col("leaf") == F.col("of_leaf")) & (F.col("form") == F.col("of_form"))).select("doc_id", "text_key", "line_no", "leaf", "template")
    marked = stored(marked, "marked")
    own = ["leaf", "template"]
    enough = marked.select(*own, "text_key").distinct().groupBy(*own).agg(F.count("*").alias("texts")).where(F.col("texts") >= min_texts)
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "line_no")
    first = marked.groupBy(*own).agg(F.min(place).alias("first"))
    # Written before the join, so that a template with very many lines is a skewed join of two plain inputs, which Spark splits.
    drop = stored(enough.join(first, own).select(F.col("leaf").alias("of_leaf"), F.col("template").alias("of"), "first"), "recurring")
    rows = marked.join(drop, (F.col("leaf") == F.col("of_leaf")) & (F.col("template") == F.col("of")))
    rows = rows.where(~place.eqNullSafe(F.col("first"))).select("doc_id", "text_key", "line_no")
    if long_tokens is None:
        return rows
    long = slim.where(F.col("tokens") >= long_tokens)
    twice = long.groupBy("leaf", "form").agg(F.min("text_key").alias("low"), F.max("text_key").alias("high"), F.min(place).alias("first")).where("low < high")
    twice = stored(twice.select(F.col("leaf").alias("of_leaf"), F.col("form").alias("of"), "first"), "long")
    long = long.join(twice, (F.col("leaf") == F.col("of_leaf")) & (F.col("form") == F.col("of")))
    return rows.union(long.where(~place.eqNullSafe(F.col("first"))).select("doc_id", "text_key", "line_no"))


def repeats(docs: DataFrame, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """(doc_id, text_key, line_no) of literal lines that two different texts hold, but for the first occurrence of each.

    Meant for texts without near duplicates: the second of two near copies would lose what it shares with the first.
    """
    parts = F.transform(F.split("text", "\n"), _flat)
    rows = docs.where(F.col("text").isNotNull()).select("doc_id", F.xxhash64("text").alias("text_key"), F.posexplode(parts).alias("line_no", "flat"))
    n = F.octet_length("flat") - F.octet_length(F.replace(F.col("flat"), F.lit(" "), F.lit(""))) + 1
    rows = rows.where((n >= min_tokens) & (F.col("flat") != ""))
    # Two hashes, as one of 64 bits would join unlike lines of very large inputs.
    rows = stored(rows.select("doc_id", "text_key", "line_no", F.xxhash64("flat").alias("form"), F.xxhash64(F.lit(7), "flat").alias("form2")), "literal")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key", "line_no")
    held = rows.groupBy("form", "form2").agg(F.min("text_key").alias("low"), F.max("text_key").alias("high"), F.min(place).alias("first"))
    held = stored(held.where("low < high").select(F.col("form").alias("of"), F.col("form2").alias("of2"), "first"), "repeated")
    found = rows.join(held, (F.col("form") == F.col("of")) & (F.col("form2") == F.col("of2")))
    return found.where(~place.eqNullSafe(F.col("first"))).select("doc_id", "text_key", "line_no")


def deduplicate(docs: DataFrame, text: str = "text", drops=recurring, counts: tuple[str, str] = ("n_lines", "n_dropped"), **how) -> DataFrame:
    """All columns of ``docs`` with the lines that ``drops`` finds (recurring ones) dropped from ``text``; added: the columns ``counts``, before which old ones of these names give way."""
    found = drops(docs.select("doc_id", named(text).alias("text")), **how).distinct().groupBy(F.col("doc_id").alias("drop_id"), F.col("text_key").alias("drop_key")).agg(F.collect_set("line_no").alias("drops"))
    # Written first: where few texts lose lines, their plain table is known to be small and the texts need no shuffle.
    found = stored(found, "drops")
    names = [c for c in docs.columns if c not in counts]
    rows = carried(docs.select(*[named(c) for c in names]), "doc_id", text).withColumnRenamed(text, "text").withColumn("key", F.xxhash64("text"))
    rows = rows.join(found, F.col("doc_id").eqNullSafe(F.col("drop_id")) & (F.col("key") == F.col("drop_key")), "left")
    parts = F.split("text", "\n")
    kept = F.array_join(F.filter(parts, lambda line, k: ~F.array_contains(F.col("drops"), k)), "\n")
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(parts)).alias(counts[0])
    n_dropped = F.when(F.col("drops").isNull(), 0).otherwise(F.size("drops")).alias(counts[1])
    after = F.when(F.col("drops").isNull(), F.col("text")).otherwise(kept).alias(text)
    columns = {"doc_id": F.col("doc_id"), text: after}
    return rows.select(*[columns[c] if c in columns else F.col("carried").getField(c).alias(c) for c in names], n_lines, n_dropped)


def cleaned(docs: DataFrame, drops=recurring, **how) -> DataFrame:
    """The columns of ``docs`` alone, without the lines that ``drops`` finds and without the documents that lose all their text by it.

    Where lines were dropped, ``n_chars`` (if there is such a number) is counted anew.
    """
    names = docs.columns
    counted = "n_chars" in names and docs.schema["n_chars"].dataType.typeName() in ("long", "integer")
    own = ("doc_id", "text", *(["n_chars"] if counted else []))
    rows = deduplicate(carried(docs, *own), drops=drops, **how).where("n_dropped = 0 OR text != ''")
    if counted:
        rows = rows.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return unpacked(rows, names, own)

"""Line dedup by a log-template tree.

Lines are put into the leaves of a tree of fixed depth: by their number of tokens, then by their leading
tokens. Tokens with digits are variable from the start. Within a leaf, tokens are counted by position;
a line's most frequent tokens are fixed, and those that are far rarer than these are variable
fields, so a field stays one however often each of its values stands. The lines of recurring templates
are taken out of a leaf and the rest is counted again, as long as that finds any: a small template is not
hidden by the values of a large one. Other lines are compared as they are, digits included. All lines
of a recurring template, and all that recur alike, are dropped, but for the first.

All expressions are built-in. Lines are reduced to hashes before the first shuffle, so only lines of
leaves that several documents share travel with their tokens; equal lines travel once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakecast.llm.common import discard, fresh, kept, stored
from lakecast.session import broadcast_if_small

FIELD = "<*>"


@dataclass(frozen=True)
class Tree:
    """``depth`` leading tokens make a leaf. A template recurs if ``documents`` have it. It has
    at least ``fixed`` fixed tokens; with variable fields, at least ``fixed_of_fields``, and that
    ``share`` of its tokens. The last two keep sentences that merely share common words. A token is
    fixed if it is in ``even`` of the documents that the line's needed fixed tokens are in. A line of
    ``long`` tokens recurs as it is if ``long_documents`` of different texts have it."""

    depth: int = 3
    documents: int = 5
    fixed: int = 3
    fixed_of_fields: int = 6
    share: float = 0.75
    even: float = 0.5
    long: int = 50
    long_documents: int = 2


#: Blanks inside a line that are not one blank: these have to be replaced, all others can stay.
_UNEVEN = r"[\x09\x0B-\x0D][\x20\x09\x0B-\x0D]*|\x20[\x20\x09\x0B-\x0D]+"


def _masked(words: Column) -> Column:
    """Fields in place of tokens that hold digits; tokens have single blanks between them."""
    # Lines without digits, by far the most, are only looked through; a token is entered at its start alone.
    return F.when(words.rlike("[0-9]"), F.regexp_replace(words, "(?<![^ ])[^ 0-9]*+[0-9][^ ]*", FIELD)).otherwise(words)


def _n_tokens(line: Column) -> Column:
    """Tokens of a trimmed line with single blanks."""
    return F.when(line == "", 0).otherwise(F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1).cast("long")


def _lines(docs: DataFrame, key: str, text: str, tree: Tree) -> DataFrame:
    """``id, hash, line_no, n, leaf, code, same, digits, masked`` of the lines with enough tokens; ``masked`` has single blanks between its ``n`` tokens.

    A document is its key and the hash of its text, so that rows without a key are documents of
    their own and repeated rows are one. Blanks are evened once for the whole text; all else is cut and counted without regular
    expressions. ``code`` is the hash of the masked line; ``same`` that of the line as it is, null where it is never asked for.
    """
    whole = F.col(text).cast("string")
    even = F.split(F.regexp_replace(whole, _UNEVEN, " "), "\n")
    lines = docs.select(F.col(key).alias("id"), F.xxhash64(whole).alias("hash"), F.posexplode(even).alias("line_no", "line"))
    lines = lines.select("id", "hash", "line_no", F.trim("line").alias("line"))
    lines = lines.withColumn("n", _n_tokens(F.col("line"))).where(F.col("n") >= tree.fixed)
    lines = lines.withColumn("masked", _masked(F.col("line")))
    asked = (F.col("masked") != F.col("line")) | (F.col("n") >= tree.long)
    return lines.select(
        "id", "hash", "line_no", "n",
        F.xxhash64("n", F.substring_index("masked", " ", tree.depth)).alias("leaf"),
        F.xxhash64("masked").alias("code"),
        F.when(asked, F.xxhash64("line")).alias("same"),
        # Only lines with digits differ from their masked form.
        (F.col("masked") != F.col("line")).alias("digits"),
        "masked",
    )


def _proposals(distinct: DataFrame, tree: Tree, least: int) -> DataFrame:
    """``leaf, code, documents, level, template, template_id``: a line's possible templates, the preferred at level 0.

    Tokens that fewer than ``least`` documents have are fields. The line needs so many fixed tokens; the rarest of
    its most frequent ones gives the measure for all: fixed is what has ``even`` of it, else what
    has all of it, else what ``documents`` have.
    """
    words = F.split("masked", " ")
    tokens = distinct.select("leaf", "code", "documents", F.size(words).alias("n"), F.posexplode(words).alias("place", "token"))
    counted = (
        tokens.where(F.col("token") != FIELD)
        .groupBy("leaf", "place", "token")
        .agg(F.sum("documents").alias("have"))
        .where(F.col("have") >= least)
    )
    # Only tokens that can be fixed travel on; the places between them are fields.
    parts = F.array_sort(F.collect_list(F.struct("place", "token", "have"))).alias("parts")
    lines = tokens.join(counted, ["leaf", "place", "token"]).groupBy("leaf", "code", "documents", "n").agg(parts)
    needed = F.greatest(F.lit(tree.fixed_of_fields), F.ceil(tree.share * F.col("n")).cast("int"))
    lines = lines.withColumn("needed", needed)
    lines = lines.where((F.size("parts") >= F.col("needed")) | (F.size("parts") == F.col("n")) & (F.col("n") >= tree.fixed))
    lines = lines.withColumn("measure", F.get(F.sort_array(F.col("parts.have"), False), F.col("needed") - 1))

    def template(cut: Column) -> Column:
        n_fixed = F.size(F.filter("parts", lambda part: part["have"] >= cut))
        enough = (n_fixed >= F.col("needed")) | (n_fixed == F.col("n"))

        def piece(part: Column, i: Column) -> Column:
            # The fields since the part before, then its token: one pass, however long the line.
            gap = part["place"] - F.coalesce(F.get("parts", i - 1)["place"], F.lit(-1)) - 1
            return F.concat(F.repeat(F.lit(f"{FIELD} "), gap), F.when(part["have"] >= cut, part["token"]).otherwise(FIELD))

        tail = F.repeat(F.lit(f" {FIELD}"), F.col("n") - 1 - F.element_at("parts", -1)["place"])
        return F.when(enough, F.concat(F.array_join(F.transform("parts", piece), " "), tail))

    cuts = (tree.even * F.col("measure"), F.col("measure"), F.lit(tree.documents))
    each = F.array_distinct(F.array_compact(F.array(*map(template, cuts))))
    return lines.select("leaf", "code", "documents", F.posexplode(each).alias("level", "template")).withColumn(
        "template_id", F.xxhash64("leaf", "template")
    )


def _templates(shared: DataFrame, distinct: DataFrame, tree: Tree) -> DataFrame:
    """``leaf, code, template_id, template`` of the distinct lines that have a recurring template.

    Only leaves in which the round before found some are counted again, so rounds shrink fast.
    """
    line, found, rest, least = ["leaf", "code"], None, distinct, tree.documents
    while True:
        proposals = stored(_proposals(rest, tree, least), "proposals")
        bounds = proposals.groupBy("template_id").agg(F.sum("documents").alias("most"))
        bounds = bounds.where(F.col("most") >= tree.documents).select("template_id")
        # A document may hold several lines of a template, so only the documents themselves tell.
        recurring = (
            shared.join(proposals.join(bounds, "template_id").select(*line, "template_id"), line)
            .select("template_id", "id", "hash")
            .distinct()
            .groupBy("template_id")
            .count()
            .where(F.col("count") >= tree.documents)
            .select("template_id")
        )
        if found is not None:
            recurring = recurring.union(found.select("template_id")).distinct()
        best = F.min(F.struct("level", "template_id", "template")).alias("best")
        chosen = proposals.join(recurring, "template_id").groupBy(*line).agg(best).select(*line, "best.template_id", "best.template")
        chosen = stored(chosen, "chosen-lines")
        found = chosen if found is None else found.unionByName(chosen)
        moved = chosen.select("leaf").distinct()
        left = rest.join(proposals.select(*line).distinct(), line, "left_semi").join(moved, "leaf", "left_semi")
        left = stored(left.join(chosen, line, "left_anti"), "distinct-lines")
        discard(proposals)
        discard(rest)
        rest = left
        if rest.isEmpty():
            return found
        # What is left of a template may be few lines, which the documents found before complete.
        least = 1


def _marked(docs: DataFrame, tree: Tree, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """``id, hash, line_no, template_id, first`` of the lines of recurring templates, and the templates."""
    # Texts are parsed once; what follows reads columns of these rows.
    lines = stored(_lines(docs, key, text, tree), "lines")
    document = ["id", "hash"]
    leaves = kept(
        lines.select("leaf", *document).distinct().groupBy("leaf").count().where(F.col("count") >= tree.documents).select("leaf")
    )
    several = lines.join(broadcast_if_small(leaves), "leaf", "left_semi")
    raw = F.when(F.col("digits"), F.col("same")).alias("raw")
    shared = stored(several.select("leaf", "code", *document, "line_no", raw), "shared-lines")

    # Every distinct line once, weighing as many as the documents that have it.
    weights = shared.select("leaf", "code", *document).distinct().groupBy("leaf", "code").agg(F.count(F.lit(1)).alias("documents"))
    texts = several.groupBy("leaf", "code").agg(F.first("masked").alias("masked"))
    distinct = stored(weights.join(texts, ["leaf", "code"]), "distinct-lines")
    templates = _templates(shared, distinct, tree)
    found = shared.join(templates.select("leaf", "code", "template_id"), ["leaf", "code"])
    found = found.select(*document, "line_no", "template_id")

    # A line that stands alike in enough documents recurs, whatever its tokens, if no template has it.
    alike = shared.where(F.col("raw").isNotNull()).join(templates, ["leaf", "code"], "left_anti").select(*document, "line_no", "raw")
    often = alike.select("raw", *document).distinct().groupBy("raw").count().where(F.col("count") >= tree.documents).select("raw")
    exact = alike.join(often, "raw").select(*document, "line_no", F.xxhash64(F.lit("alike"), "raw").alias("template_id"))
    found = stored(found.unionByName(exact), "templates")
    discard(shared)

    # A long line recurs from fewer documents on. Copies of a whole document are one here: they are no
    # different documents, and where they are few, near-duplicate removal takes them.
    long = lines.where(F.col("n") >= tree.long).select(*document, "line_no", F.col("same").alias("raw"))
    often = long.select("raw", "hash").distinct().groupBy("raw").count().where(F.col("count") >= tree.long_documents).select("raw")
    exact = long.join(often, "raw").select(*document, "line_no", F.xxhash64(F.lit("alike"), "raw").alias("template_id"))
    at = [F.col(f"x.{c}").eqNullSafe(F.col(f"f.{c}")) for c in (*document, "line_no")]
    found = found.unionByName(stored(exact.alias("x").join(found.alias("f"), at, "left_anti"), "long-templates"))
    discard(lines)

    place = F.struct(F.col("id").isNull().alias("last"), "id", "hash", "line_no")
    firsts = kept(found.groupBy("template_id").agg(F.min(place).alias("at")))
    # A template may be on every page: its lines meet its first one without being brought together, where that fits.
    marks = found.join(broadcast_if_small(firsts), "template_id").select(*document, "line_no", "template_id", place.eqNullSafe(F.col("at")).alias("first"))
    return marks, templates


def recurring_lines(docs: DataFrame, tree: Tree = Tree(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, hash, line_no, template, first``: the lines of recurring templates.

    ``template`` is null for lines that recur as they are. ``first`` marks a template's first line, in the order of key (nulls last), text hash and line number.
    """
    marks, templates = _marked(docs, tree, key, text)
    texts = templates.groupBy("template_id").agg(F.first("template").alias("template"))
    return marks.join(texts, "template_id", "left").select("id", "hash", "line_no", "template", "first")


def drop_recurring(docs: DataFrame, tree: Tree = Tree(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without recurring lines, with ``lines_dropped`` and ``emptied`` added.

    The first line of a template stays, so nothing is lost altogether: of many copies of a
    document, the one with the smallest key stays whole. ``emptied`` marks rows that had words
    and have none left. Lines of fewer than ``tree.fixed`` tokens and documents without recurring lines
    are left as they are.

    Nulls: a null text stays null and counts no lines; rows without a key are documents of their own. Repeated
    rows count as one document and are cut alike. Very long texts count whole. An empty table
    gives an empty result. Added columns get a trailing underscore where ``docs`` uses the name.
    """
    dropped, emptied = fresh(docs, "lines_dropped"), fresh(docs, "emptied")
    drops = (
        _marked(docs, tree, key, text)[0]
        .where(~F.col("first"))
        .groupBy("id", "hash")
        .agg(F.collect_set("line_no").alias("drops"))
    )
    whole = F.col(f"d.`{text}`").cast("string")
    joined = docs.alias("d").join(
        drops.alias("x"), F.col(f"d.`{key}`").eqNullSafe(F.col("x.id")) & (F.xxhash64(whole) == F.col("x.hash")), "left"
    )
    left = F.array_join(F.filter(F.split(whole, "\n"), lambda line, i: ~F.array_contains("x.drops", i)), "\n")
    cut = F.when(F.col("x.drops").isNull(), whole).otherwise(left)
    return joined.select(
        *((cut.alias(c) if c == text else F.col(f"d.`{c}`")) for c in docs.columns),
        F.when(F.col("x.drops").isNull(), 0).otherwise(F.size("x.drops")).cast("long").alias(dropped),
        (F.col("x.drops").isNotNull() & (F.length(F.regexp_replace(cut, r"[\x20\x09-\x0D]+", "")) == 0)).alias(emptied),
    )


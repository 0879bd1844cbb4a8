"""Order-insensitive comparison of XML documents, as a join of their nodes.

Two nodes pair when all their ancestors pair and they stand at the same place
among their sorted siblings: an inner join on the path of sibling positions.

Documents pair by id. Where an id, or null, has several documents on a side, equal ones pair first and the rest in the
order of their digests; what is left over is of one side only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywise.functions.columns import col
from tallywise.functions.compare import differs, same_map
from tallywise.operators.numbering import repeat_rows, start_in_order
from tallywise.session import stored
from tallywise.sources.xmldocs import broken_documents, met_nodes, text_digest, unequal_nodes


def _blank_as_null(column: Column, ignore_whitespace: bool) -> Column:
    if not ignore_whitespace:
        return column
    return F.when(F.trim(F.translate(column, "\t\r\n", "   ")) != "", column)


def _attributes_json(attrs: Column) -> Column:
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(attrs))))


def _uneven(base: DataFrame, actual: DataFrame) -> DataFrame:
    """``_id, _digest, _nb, _na`` of the documents that the sides do not hold equally often, from ``_id, _digest``."""
    both = base.select("_id", "_digest", F.lit(1).alias("_s")).unionAll(actual.select("_id", "_digest", F.lit(0).alias("_s")))
    counts = both.groupBy("_id", "_digest").agg(F.sum("_s").alias("_nb"), F.sum(1 - F.col("_s")).alias("_na"))
    return stored(counts.where("_nb <> _na"), "uneven-documents")


def _pairs(uneven: DataFrame) -> DataFrame:
    """``_id, _no, _b, _a``: which documents are compared, by their digests; null where a side has none left."""
    more_b, more_a = F.greatest(F.col("_nb") - F.col("_na"), F.lit(0)), F.greatest(F.col("_na") - F.col("_nb"), F.lit(0))
    of_id = uneven.groupBy("_id").agg(
        F.sum(more_b).alias("_mb"), F.sum(more_a).alias("_ma"),
        F.max(F.when(more_b > 0, F.col("_digest"))).alias("_b"), F.max(F.when(more_a > 0, F.col("_digest"))).alias("_a"),
    )
    of_id = stored(of_id, "document-pairs")
    single = of_id.where("_mb <= 1 and _ma <= 1").select("_id", F.lit(0).cast("bigint").alias("_no"), "_b", "_a")
    several = uneven.join(of_id.where("_mb > 1 or _ma > 1").select("_id"), "_id", "left_semi")

    def numbered(more: Column, name: str) -> DataFrame:
        rest = several.select("_id", "_digest", more.alias("_n")).where("_n > 0")
        copies = repeat_rows(start_in_order(rest, ["_id"], [F.col("_digest")], F.col("_n"), "_start"), "_n", "_copy")
        return copies.select("_id", (F.col("_start") + F.col("_copy")).alias("_no"), F.col("_digest").alias(name))

    return stored(single.unionByName(numbered(more_b, "_b").join(numbered(more_a, "_a"), ["_id", "_no"], "full")), "document-pairs")


def _has_copies(uneven: DataFrame) -> bool:
    """Whether a document that takes part in a pair stands several times on a side."""
    return not uneven.where("_nb > 1 or _na > 1").isEmpty()


def _reported(pairs: DataFrame, broken: DataFrame, uneven: DataFrame) -> DataFrame:
    """Rows on whole documents: those of one side only, and equal ones that do not parse.

    ``broken`` has ``_id, _digest, error`` of every document of the base that does not parse.
    """
    alone = pairs.where("_b is null or _a is null").select(
        F.col("_id.id").alias("doc_id"), F.lit("").alias("path"), F.lit("Document").alias("kind"),
        F.when(F.col("_b").isNotNull(), "present").alias("base_value"), F.when(F.col("_a").isNotNull(), "present").alias("actual_value"),
    )
    equal = broken.groupBy("_id", "_digest").agg(F.count(F.lit(1)).alias("_all"), F.min("error").alias("error"))
    equal = equal.join(uneven, ["_id", "_digest"], "left").withColumn("_n", F.coalesce(F.least("_nb", "_na"), F.col("_all")))
    copies = repeat_rows(equal.select("_id", "error", "_n"), "_n", "_copy")
    return alone.unionByName(copies.select(
        F.col("_id.id").alias("doc_id"), F.lit("").alias("path"), F.lit("Parse error").alias("kind"),
        F.col("error").alias("base_value"), F.col("error").alias("actual_value"),
    ))


_FIELDS = ["parent_path", "tag", "text", "tail", "attrs", "n_children", "error"]


def _node_differences(base: DataFrame, actual: DataFrame, ignore_whitespace: bool) -> DataFrame:
    """Differences of nodes that pair by ``_id, _no, ord_path``; ``_id`` is a struct, so a null id pairs too."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select("_id", "_no", "ord_path", F.struct(*_FIELDS).alias(name))

    pairs = side(base, "b").join(side(actual, "a"), ["_id", "_no", "ord_path"])
    b, a = F.col("b"), F.col("a")
    own_path = F.concat(b["parent_path"], F.lit("/"), b["tag"])

    def text_of(node: Column, field: str) -> Column:
        return _blank_as_null(node[field], ignore_whitespace)

    def found(path: Column, kind: str, left: Column, right: Column, unequal: Column) -> Column:
        return F.struct(path.alias("path"), F.lit(kind).alias("kind"), left.cast("string").alias("base_value"),
                        right.cast("string").alias("actual_value"), unequal.alias("unequal"))

    broken = b["error"].isNotNull() | a["error"].isNotNull()
    whole = ~broken
    checks = [
        found(b["parent_path"], "Tag", b["tag"], a["tag"], whole & differs(b["tag"], a["tag"]))
    ]
    for kind, field in (("Text", "text"), ("Tail", "tail")):
        left, right = text_of(b, field), text_of(a, field)
        checks.append(found(own_path, kind, left, right, whole & differs(left, right)))
    checks.append(found(own_path, "Attributes", _attributes_json(b["attrs"]), _attributes_json(a["attrs"]),
                        whole & ~same_map(b["attrs"], a["attrs"])))
    checks.append(found(own_path, "Children count", b["n_children"], a["n_children"],
                        whole & differs(b["n_children"], a["n_children"])))
    checks.append(found(F.lit(""), "Parse error", b["error"], a["error"], broken))
    return pairs.select(F.col("_id.id").alias("doc_id"), F.inline(F.filter(F.array(*checks), lambda d: d["unequal"]))).drop("unequal")


def tree_diff(base: DataFrame, actual: DataFrame, ignore_whitespace: bool = False) -> DataFrame:
    """Differences of paired nodes: ``doc_id, path, kind, base_value, actual_value``.

    Both frames come from ``shred_xml``. Surplus children show only in the count
    of their parent, a document of one side only as one row of kind ``Document``. Documents with equal text are not
    joined. The join key holds the place in the document, so one large document spreads over many tasks. Both frames are
    read twice; of texts that are not shredded yet, ``compare_documents`` says the same in one pass. Runs jobs.
    """
    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumn("_id", F.struct(F.col("doc_id").alias("id"))).withColumnRenamed("doc_digest", "_digest")

    base, actual = keyed(base), keyed(actual)
    roots = [side.where(F.size("ord_path") == 0).select("_id", "_digest", "error") for side in (base, actual)]
    uneven = _uneven(*[r.select("_id", "_digest") for r in roots])
    pairs = _pairs(uneven)

    both, copied = pairs.where("_b is not null and _a is not null"), _has_copies(uneven)

    def nodes(df: DataFrame, name: str) -> DataFrame:
        """The nodes of paired documents; copies of one document count once for each pair."""
        found = df.join(both.select("_id", "_no", F.col(name).alias("_digest")), ["_id", "_digest"])
        return found.dropDuplicates(["_id", "_no", "ord_path"]) if copied else found

    found = _node_differences(nodes(base, "_b"), nodes(actual, "_a"), ignore_whitespace)
    return found.unionByName(_reported(pairs, roots[0].where("error is not null"), uneven))


def _compare_copies(base: DataFrame, actual: DataFrame, doc_id: str, xml: str, ignore_whitespace: bool) -> DataFrame:
    """``compare_documents`` of ids with several documents on a side, which pair by digests."""
    def texts(df: DataFrame) -> DataFrame:
        return df.select(F.struct(col(doc_id).alias("id")).alias("_id"), text_digest(col(xml)).alias("_digest"), col(xml).alias("_xml"))

    base, actual = texts(base), texts(actual)
    uneven = _uneven(base, actual)
    pairs = _pairs(uneven)
    both, copied = pairs.where("_b is not null and _a is not null"), _has_copies(uneven)

    def side(df: DataFrame, name: str) -> DataFrame:
        wanted = both.select("_id", "_no", F.col(name).alias("_digest"))
        met = df.join(wanted, ["_id", "_digest"]).select("_id", "_no", F.col("_xml").alias(name))
        return met.dropDuplicates(["_id", "_no"]) if copied else met

    meeting = side(base, "_b").join(side(actual, "_a"), ["_id", "_no"])
    nodes = stored(unequal_nodes(meeting, ["_id", "_no"], "_b", "_a"), "unequal-nodes")
    found = _node_differences(nodes.where("is_base"), nodes.where("not is_base"), ignore_whitespace)
    broken = stored(broken_documents(base, ["_id", "_digest"], "_xml"), "broken-documents")
    return found.unionByName(_reported(pairs, broken, uneven))


def compare_documents(base: DataFrame, actual: DataFrame, doc_id: str, xml: str,
                      ignore_whitespace: bool = False) -> DataFrame:
    """``tree_diff`` of two corpora in one pass over their texts.

    The texts of an id meet in one row by one shuffle. Equal ones are only checked for parse errors. Of unequal ones
    that differ as trees, a digest of every subtree, made from the leaves up, cuts off what is equal, and only the nodes
    above a difference become rows and are joined. Ids with several documents on a side are counted there, and read
    again to be paired by digests. Runs jobs when called.
    """
    ident = F.struct(col(doc_id).alias("id")).alias("_id")
    both = base.select(ident, col(xml).alias("_xml"), F.lit(1).alias("_s")).unionAll(actual.select(ident, col(xml).alias("_xml"), F.lit(0).alias("_s")))
    of_id = both.groupBy("_id").agg(
        F.sum("_s").alias("_nb"), F.sum(1 - F.col("_s")).alias("_na"),
        F.any_value(F.when(F.col("_s") == 1, F.col("_xml")), F.lit(True)).alias("_b"),
        F.any_value(F.when(F.col("_s") == 0, F.col("_xml")), F.lit(True)).alias("_a"),
    )
    met = stored(met_nodes(of_id, ["_id", "_nb", "_na"], "_b", "_a"), "unequal-nodes")
    nodes = met.where("is_base is not null").withColumn("_no", F.lit(0))
    found = _node_differences(nodes.where("is_base"), nodes.where("not is_base"), ignore_whitespace)
    found = found.unionByName(met.where("_nb + _na = 1").select(
        F.col("_id.id").alias("doc_id"), F.lit("").alias("path"), F.lit("Document").alias("kind"),
        F.when(F.col("_nb") > 0, "present").alias("base_value"), F.when(F.col("_na") > 0, "present").alias("actual_value"),
    ))
    several = met.where("_nb > 1 or _na > 1").select("_id")
    if several.isEmpty():
        return found
    copies = [df.withColumn("_id", ident).join(several, "_id", "left_semi").drop("_id") for df in (base, actual)]
    return found.unionByName(_compare_copies(*copies, doc_id, xml, ignore_whitespace))

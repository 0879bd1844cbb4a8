"""XML documents as node rows."""

from __future__ import annotations

import hashlib
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywise.functions.columns import col

#: Node rows gathered before a batch goes back to Spark.
_NODES_PER_BATCH = 20000


def read_xml_records(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    """Record-style XML files with Spark's own reader."""
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)


def _sibling_order(element: ET.Element):
    return element.tag, sorted(element.attrib.items())


def _node_rows(text: str | None) -> Iterator[tuple]:
    """Nodes of one document: place, tags above, tag, text, tail, attributes, children, error."""
    try:
        root = ET.fromstring(text)
    except (ET.ParseError, TypeError, ValueError) as problem:
        yield [], "", None, None, None, [], 0, str(problem)
        return
    waiting = [(root, [], "")]
    while waiting:
        node, place, above = waiting.pop()
        yield place, above, node.tag, node.text, node.tail, list(node.attrib.items()), len(node), None
        if len(node):
            path = f"{above}/{node.tag}"
            for i, child in enumerate(sorted(node, key=_sibling_order)):
                waiting.append((child, [*place, i], path))


_NODE_TYPES = {
    "ord_path": pa.list_(pa.int32()),
    "parent_path": pa.string(),
    "tag": pa.string(),
    "text": pa.string(),
    "tail": pa.string(),
    "attrs": pa.map_(pa.string(), pa.string()),
    "n_children": pa.int32(),
    "error": pa.string(),
}


def _shred(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, digests, docs = batch.column(0), batch.column(1), batch.column(2)
        owners: list[int] = []
        rows: list[tuple] = []

        def node_batch() -> pa.RecordBatch:
            fields = zip(*rows)
            arrays = [pa.array(list(values), kind) for values, kind in zip(fields, _NODE_TYPES.values())]
            owner = pa.array(owners, pa.int64())
            return pa.record_batch([ids.take(owner), digests.take(owner), *arrays], ["doc_id", "doc_digest", *_NODE_TYPES])

        for i in range(len(docs)):
            for row in _node_rows(docs[i].as_py()):
                owners.append(i)
                rows.append(row)
                if len(rows) >= _NODES_PER_BATCH:
                    yield node_batch()
                    owners, rows = [], []
        if rows:
            yield node_batch()


def text_digest(text: Column) -> Column:
    """128 bits of a SHA-256 of a text; those of null are empty."""
    return F.coalesce(F.unhex(F.substring(F.sha2(text, 256), 1, 32)), F.unhex(F.lit("")))


def shred_xml(df: DataFrame, doc_id: str, xml: str) -> DataFrame:
    """One row per element, siblings sorted by tag and attributes.

    ``ord_path`` holds the sorted positions from the root down and ``parent_path``
    the tags above; ``doc_digest`` tells documents of one id apart. A document that does not parse gives one row with
    ``error`` set. Each document is parsed by one task.
    """
    schema = T.StructType([
        T.StructField("doc_id", df.schema[doc_id].dataType),
        T.StructField("doc_digest", T.BinaryType()),
        T.StructField("ord_path", T.ArrayType(T.IntegerType())),
        T.StructField("parent_path", T.StringType()),
        T.StructField("tag", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("tail", T.StringType()),
        T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
        T.StructField("n_children", T.IntegerType()),
        T.StructField("error", T.StringType()),
    ])
    return df.select(col(doc_id).alias("id"), text_digest(col(xml)).alias("digest"), col(xml).alias("xml")).mapInArrow(_shred, schema)


class _Checked:
    """Takes a parser's events and makes nothing of them."""

    def close(self) -> None:
        return None


def _problem(text: str | None) -> str | None:
    """Why a text is no XML document; None if it is one."""
    if text is not None and "<!DOCTYPE" not in text:  # without one, ElementTree accepts what the bare parser does
        try:
            expat.ParserCreate(namespace_separator="}").Parse(text, True)
            return None
        except (expat.ExpatError, ValueError):
            pass
    try:
        parser = ET.XMLParser(target=_Checked())
        parser.feed(text)
        parser.close()
    except (ET.ParseError, TypeError, ValueError) as problem:
        return str(problem)
    return None


def broken_documents(df: DataFrame, keys: list[str], xml: str) -> DataFrame:
    """``keys`` and ``error`` of the documents that do not parse; no tree is built of the others."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(i, problem) for i, text in enumerate(batch.column(len(keys))) if (problem := _problem(text.as_py())) is not None]
            rows = pa.array([i for i, _ in found], pa.int64())
            yield pa.record_batch([*[batch.column(k).take(rows) for k in range(len(keys))], pa.array([e for _, e in found], pa.string())], [*keys, "error"])

    schema = T.StructType([*[df.schema[k] for k in keys], T.StructField("error", T.StringType())])
    return df.select(*[col(k) for k in keys], col(xml)).mapInArrow(check, schema)


def _sorted_with_digests(root: ET.Element) -> dict[ET.Element, tuple[list[ET.Element], bytes]]:
    """Of every element its children in sibling order and a digest of all that it holds, made from the leaves up."""
    out: dict[ET.Element, tuple[list[ET.Element], bytes]] = {}
    for node in reversed(list(root.iter())):
        children = sorted(node, key=_sibling_order)
        own = repr((node.tag, node.text, node.tail, sorted(node.attrib.items()), len(children)))
        digest = hashlib.blake2b(own.encode("utf-8", "surrogatepass"), digest_size=16)
        for child in children:
            digest.update(out[child][1])
        out[node] = children, digest.digest()
    return out


def _same(base: ET.Element, actual: ET.Element) -> bool:
    """Whether two trees are equal once siblings are sorted; attributes have no order."""
    waiting = [(base, actual)]
    while waiting:
        b, a = waiting.pop()
        if b.tag != a.tag or b.attrib != a.attrib or b.text != a.text or b.tail != a.tail or len(b) != len(a):
            return False
        if len(b) == 1:
            waiting.append((b[0], a[0]))
        elif len(b):
            waiting.extend(zip(sorted(b, key=_sibling_order), sorted(a, key=_sibling_order)))
    return True


def _unequal_nodes(base: str | None, actual: str | None) -> Iterator[tuple]:
    """Nodes of two documents, each with its side (True for base), but for subtrees that are equal."""
    roots = []
    for is_base, text in ((True, base), (False, actual)):
        try:
            roots.append(ET.fromstring(text))
        except (ET.ParseError, TypeError, ValueError):
            roots.append(None)
    if None in roots:  # one row of each side is enough to report a parse error
        yield True, *next(_node_rows(base))
        yield False, *next(_node_rows(actual))
        return
    if _same(*roots):
        return
    known = [_sorted_with_digests(root) for root in roots]
    waiting = [(roots[0], roots[1], [], "")]
    while waiting:
        b, a, place, above = waiting.pop()
        (b_children, b_digest), (a_children, a_digest) = known[0][b], known[1][a]
        if b_digest == a_digest:
            continue
        for is_base, node in ((True, b), (False, a)):
            yield is_base, place, above, node.tag, node.text, node.tail, list(node.attrib.items()), len(node), None
        for i, (x, y) in enumerate(zip(b_children, a_children)):
            waiting.append((x, y, [*place, i], f"{above}/{b.tag}"))


#: Documents whose texts are taken out of a batch at a time.
_DOCS_AT_ONCE = 500


def _pair_nodes(df: DataFrame, keys: list[str], texts: list[str], rows_of: Callable[..., Iterator[tuple]]) -> DataFrame:
    """``keys`` with the rows (``is_base`` and a node) that ``rows_of`` makes of the columns ``texts`` of a row."""
    kinds = {"is_base": pa.bool_(), **_NODE_TYPES}

    def shred(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners: list[int] = []
            rows: list[tuple] = []

            def node_batch() -> pa.RecordBatch:
                owner = pa.array(owners, pa.int64())
                arrays = [pa.array(list(values), kind) for values, kind in zip(zip(*rows), kinds.values())]
                return pa.record_batch([*[batch.column(k).take(owner) for k in range(len(keys))], *arrays], [*keys, *kinds])

            for begin in range(0, batch.num_rows, _DOCS_AT_ONCE):
                some = batch.slice(begin, _DOCS_AT_ONCE)
                for i, given in enumerate(zip(*[some.column(len(keys) + t).to_pylist() for t in range(len(texts))]), begin):
                    for row in rows_of(*given):
                        owners.append(i)
                        rows.append(row)
                        if len(rows) >= _NODES_PER_BATCH:
                            yield node_batch()
                            owners, rows = [], []
            if rows:
                yield node_batch()

    schema = T.StructType([
        *[df.schema[k] for k in keys], T.StructField("is_base", T.BooleanType()), T.StructField("ord_path", T.ArrayType(T.IntegerType())),
        *[T.StructField(c, T.StringType()) for c in ("parent_path", "tag", "text", "tail")],
        T.StructField("attrs", T.MapType(T.StringType(), T.StringType())), T.StructField("n_children", T.IntegerType()), T.StructField("error", T.StringType()),
    ])
    return df.select(*[col(k) for k in keys], *[col(t) for t in texts]).mapInArrow(shred, schema)


def unequal_nodes(pairs: DataFrame, keys: list[str], base_xml: str, actual_xml: str) -> DataFrame:
    """Node rows of both sides of paired documents (``is_base``), without the subtrees in which a pair is equal."""
    return _pair_nodes(pairs, keys, [base_xml, actual_xml], _unequal_nodes)


def _events(text: str | None) -> list | None:
    """Tags, attributes and texts of a document in turn; None if it does not parse or declares a type."""
    if text is None or "<!DOCTYPE" in text:
        return None
    out: list = []
    parser = expat.ParserCreate(namespace_separator="}")
    parser.buffer_text = True
    parser.StartElementHandler = lambda *start: out.append(start)
    parser.EndElementHandler = parser.CharacterDataHandler = out.append
    try:
        parser.Parse(text, True)
    except (expat.ExpatError, ValueError):
        return None
    return out


def _met_nodes(n_base: int, n_actual: int, base: str | None, actual: str | None) -> Iterator[tuple]:
    if n_base != 1 or n_actual != 1:
        yield None, *[None] * len(_NODE_TYPES)
    elif base == actual:
        if _problem(base) is not None:
            yield from _unequal_nodes(base, actual)
    elif (events := _events(base)) is None or events != _events(actual):  # documents of equal events are equal trees
        yield from _unequal_nodes(base, actual)


def met_nodes(ids: DataFrame, keys: list[str], base_xml: str, actual_xml: str) -> DataFrame:
    """``unequal_nodes`` of ids, with the rows of equal documents that do not parse.

    The last two of ``keys`` count an id's documents on each side. One that has not one on each gives one row without a
    node (``is_base`` null).
    """
    return _pair_nodes(ids, keys, [*keys[-2:], base_xml, actual_xml], _met_nodes)


def malformed_documents(nodes: DataFrame) -> DataFrame:
    return nodes.where(F.col("error").isNotNull()).select("doc_id", "error")

import random
import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from tallywise.functions.labels import column_letters
from tallywise.operators import grid
from tallywise.operators.tree import compare_documents, tree_diff
from tallywise.sources.cells import to_cells
from tallywise.sources.xmldocs import broken_documents, malformed_documents, read_xml_records, shred_xml, unequal_nodes
from tests.conftest import rows

CELLS = "sheet string, row_no bigint, col_no int, value string"


def test_grid_pairs_by_position(spark):
    base = spark.createDataFrame([("S", 1, 1, "a"), ("S", 2, 1, "2.001"), ("S", 3, 1, None), ("S", 9, 28, "x"), ("B", 1, 1, "q")], CELLS)
    actual = spark.createDataFrame([("S", 1, 1, "b"), ("S", 2, 1, "2.0014"), ("A", 1, 1, "q")], CELLS)
    exact = [("S", 1, 1, "A1", "a", "b"), ("S", 2, 1, "A2", "2.001", "2.0014"), ("S", 9, 28, "AB9", "x", None)]
    assert rows(grid.grid_diff(base, actual)) == exact
    assert rows(grid.grid_diff(base, actual, round_off=2)) == [exact[0], exact[2]]
    assert rows(grid.sheet_diff_counts(grid.grid_diff(base, actual))) == [("S", 3)]
    assert rows(grid.sheet_presence(base, actual)) == [("A", "actual"), ("B", "base"), ("S", "both")]
    assert rows(grid.grid_status(base, actual)) == [(3, "compare complete")]
    assert rows(grid.grid_report(grid.grid_diff(base, actual)))[0] == ("S", "A1", "a", "b")


def test_no_common_sheet(spark):
    base = spark.createDataFrame([("S", 1, 1, "a")], CELLS)
    actual = spark.createDataFrame([("T", 1, 1, "a")], CELLS)
    assert rows(grid.grid_status(base, actual)) == [(-1, "No Common sheets found")]


def test_column_letters(spark):
    numbers = [1, 26, 27, 52, 53, 702, 703, 728, 729, 16384]
    df = spark.createDataFrame([(n,) for n in numbers], "n int")
    found = {r[0]: r[1] for r in df.select("n", column_letters(F.col("n"))).collect()}
    assert [found[n] for n in numbers] == ["A", "Z", "AA", "AZ", "BA", "ZZ", "AAA", "AAZ", "ABA", "XFD"]


def test_to_cells_with_given_row_numbers(spark):
    df = spark.createDataFrame([("S", 4, 1.5, None)], "s string, r int, a double, b string")
    assert rows(to_cells(df, "s", ["a", "b"], row_no="r")) == [("S", 4, 1, "1.5"), ("S", 4, 2, None)]
    with pytest.raises(ValueError):
        to_cells(df, "s", ["a"])


def random_tree(rng, depth=0):
    node = ET.Element(rng.choice("abc"), {k: rng.choice("12") for k in rng.sample("xy", rng.randrange(3))})
    node.text = rng.choice([None, "t", "u", " "])
    node.tail = rng.choice([None, "\n"]) if depth else None
    for _ in range(rng.randrange(4) if depth < 3 else 0):
        node.append(random_tree(rng, depth + 1))
    return node


def brute(base, actual):
    """Differences of two trees by walking both, siblings sorted and paired in order."""
    out = []

    def attributes(node):
        return "{" + ",".join(f'"{k}":"{v}"' for k, v in sorted(node.attrib.items())) + "}"

    def order(node):
        return sorted(node, key=lambda n: (n.tag, sorted(n.attrib.items())))

    todo = [("", base, actual)]
    while todo:
        above, b, a = todo.pop()
        own = f"{above}/{b.tag}"
        checks = [(above, "Tag", b.tag, a.tag), (own, "Text", b.text, a.text), (own, "Tail", b.tail, a.tail),
                  (own, "Attributes", attributes(b), attributes(a)),
                  (own, "Children count", str(len(b)), str(len(a)))]
        out += [c for c in checks if c[2] != c[3]]
        todo += [(own, x, y) for x, y in zip(order(b), order(a))]
    return out


def test_random_trees_match_brute_force(spark):
    rng = random.Random(3)
    docs = [(i, ET.tostring(random_tree(rng), encoding="unicode"), ET.tostring(random_tree(rng), encoding="unicode"))
            for i in range(120)]
    expected = [(i, *d) for i, b, a in docs for d in brute(ET.fromstring(b), ET.fromstring(a))]
    df = spark.createDataFrame(docs, "id int, b string, a string")
    base, actual = df.select("id", F.col("b").alias("xml")), df.select("id", F.col("a").alias("xml"))
    found = rows(tree_diff(shred_xml(base, "id", "xml"), shred_xml(actual, "id", "xml")))
    assert found == sorted(expected, key=repr) and len(found) > 200
    assert rows(compare_documents(base, actual, "id", "xml")) == found


def test_order_of_siblings_and_attributes_does_not_matter(spark):
    base = spark.createDataFrame([(1, '<r><b q="1" p="2"/><a>x</a></r>')], "id int, xml string")
    actual = spark.createDataFrame([(1, '<r><a>x</a><b p="2" q="1"/></r>')], "id int, xml string")
    assert compare_documents(base, actual, "id", "xml").isEmpty()


def test_whitespace_counts_unless_ignored(spark):
    base = spark.createDataFrame([(1, "<r>\n <a/>\n</r>")], "id int, xml string")
    actual = spark.createDataFrame([(1, "<r><a/></r>")], "id int, xml string")
    assert {r["kind"] for r in compare_documents(base, actual, "id", "xml").collect()} == {"Text", "Tail"}
    assert compare_documents(base, actual, "id", "xml", ignore_whitespace=True).isEmpty()


def test_broken_documents_are_reported(spark):
    base = spark.createDataFrame([(1, "<r>"), (2, "<r/>"), (3, None)], "id int, xml string")
    actual = spark.createDataFrame([(1, "<r/>"), (2, "<r/>"), (3, "<r/>")], "id int, xml string")
    found = tree_diff(shred_xml(base, "id", "xml"), shred_xml(actual, "id", "xml")).collect()
    assert sorted((r["doc_id"], r["kind"]) for r in found) == [(1, "Parse error"), (3, "Parse error")]
    assert rows(malformed_documents(shred_xml(base, "id", "xml")).select("doc_id")) == [(1,), (3,)]


def test_a_document_larger_than_one_batch_is_whole(spark):
    text = "<r>" + "".join(f"<n{i}>{i}</n{i}>" for i in range(45000)) + "</r>"
    nodes = shred_xml(spark.createDataFrame([(1, text)], "id int, xml string"), "id", "xml")
    assert nodes.count() == 45001
    assert nodes.agg(F.count_distinct("ord_path")).first()[0] == 45001


def test_record_style_files(spark, tmp_path):
    (tmp_path / "r.xml").write_text("<rows><row><a>1</a><b>x</b></row><row><a>2</a></row></rows>")
    assert rows(read_xml_records(spark, str(tmp_path / "r.xml"), "row", "a int, b string")) == [(1, "x"), (2, None)]


def both_ways(spark, base, actual):
    frames = [spark.createDataFrame(side, "id long, xml string") for side in (base, actual)]
    found = rows(compare_documents(*frames, "id", "xml"))
    assert rows(tree_diff(*[shred_xml(f, "id", "xml") for f in frames])) == found
    return found


def test_documents_without_id_and_of_one_id_are_compared(spark):
    docs = [(None, "<a>1</a>"), (None, "<b/>"), (1, "<r><x/></r>"), (1, "<r><x/></r>"), (1, "<r><y/></r>"), (2, "<a"), (None, None), (3, "<q/>")]
    assert [d for d in both_ways(spark, docs, docs) if d[2] != "Parse error"] == []
    assert both_ways(spark, [(None, "<a>1</a>")], [(None, "<a>2</a>")]) == [(None, "/a", "Text", "1", "2")]
    # One of three copies has changed; equal copies pair first, so only that one is reported.
    assert both_ways(spark, [(1, "<r>s</r>")] * 3, [(1, "<r>s</r>")] * 2 + [(1, "<r>t</r>")]) == [(1, "/r", "Text", "s", "t")]
    assert both_ways(spark, [(1, "<r>s</r>")] * 3, [(1, "<r>t</r>")] * 2) == [(1, "", "Document", "present", None)] + [(1, "/r", "Text", "s", "t")] * 2
    broken = both_ways(spark, [(2, "<a"), (2, "<a"), (2, "<a"), (4, "<b")], [(2, "<a"), (2, "<a"), (4, "<b/>")])
    assert [(d[0], d[2]) for d in broken] == [(2, "Document"), (2, "Parse error"), (2, "Parse error"), (4, "Parse error")]


def test_equal_subtrees_are_cut_off_before_nodes_are_joined(spark):
    same = "".join(f"<n k='{i}'><m>{i}</m></n>" for i in range(500))
    df = spark.createDataFrame([(1, f"<r>{same}<z><y>1</y></z></r>", f"<r>{same}<z><y>2</y></z></r>")], "k long, b string, a string")
    assert unequal_nodes(df, ["k"], "b", "a").count() == 2 * 3
    found = both_ways(spark, [(1, df.first()["b"])], [(1, df.first()["a"])])
    assert found == [(1, "/r/z/y", "Text", "1", "2")]


def test_only_broken_documents_come_back_from_the_check(spark):
    docs = [(1, "<a/>"), (2, "<a>"), (3, None), (4, ""), (5, "<a>&nope;</a>"), (6, "<p:a/>"), (7, "<a>\u00e9</a>"), (8, "x")]
    df = spark.createDataFrame(docs, "id long, xml string")
    expected = {r["doc_id"]: r["error"] for r in malformed_documents(shred_xml(df, "id", "xml")).collect()}
    assert {r["id"]: r["error"] for r in broken_documents(df, ["id"], "xml").collect()} == expected and set(expected) == {2, 3, 4, 5, 6, 8}


def test_documents_are_compared_in_one_pass_over_texts_of_other_attribute_order(spark, monkeypatch):
    from tallywise.operators import tree
    from tallywise.sources import xmldocs

    def side(*docs):
        return spark.createDataFrame([(i, d) for i, d in docs], "id int, xml string")

    monkeypatch.setattr(tree, "text_digest", None)  # only ids with several documents need digests
    base = side((1, '<r><l a="1" b="2"/>t</r>'), (2, '<r><l a="1" b="2"/></r>'), (3, "<r>"), (4, "<r/>"), (6, "<r x='&e;'/>"), (7, "<r>a<!-- c -->b</r>"), (None, "<r/>"))
    actual = side((1, '<r><l b="2" a="1"/>t</r>'), (2, '<r><l b="3" a="1"/></r>'), (3, "<r>"), (5, "<r/>"), (6, "<r x='&e;'/>"), (7, "<r>ab</r>"), (None, "<r> </r>"))
    found = tree.compare_documents(base, actual, "id", "xml")
    assert rows(found.select("doc_id", "path", "kind")) == sorted([
        (2, "/r/l", "Attributes"), (3, "", "Parse error"), (4, "", "Document"), (5, "", "Document"), (6, "", "Parse error"), (None, "/r", "Text"),
    ], key=repr)
    monkeypatch.undo()
    both = [shred_xml(df, "id", "xml") for df in (base, actual)]
    assert rows(found) == rows(tree.tree_diff(*both))
    unparsed = [0]
    monkeypatch.setattr(xmldocs, "_unequal_nodes", lambda *texts: unparsed.append(1) or iter(()))
    assert list(xmldocs._met_nodes(1, 1, '<r><l a="1" b="2"/></r>', '<r><l b="2" a="1"/></r>')) == [] and unparsed == [0]
    for text in ("<r><p:a/></r>", '<r xmlns="u"><a b="1"/></r>', "<r a='1' a='2'/>", "<!DOCTYPE r [<!ENTITY e 'x'>]><r>&e;</r>", "<!DOCTYPE r SYSTEM 'u'><r>&e;</r>", "a", ""):
        try:
            ET.fromstring(text)
            problem = None
        except ET.ParseError as error:
            problem = str(error)
        assert xmldocs._problem(text) == problem

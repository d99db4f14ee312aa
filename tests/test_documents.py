"""Documents, facts, versions, checks, files and streams."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tripleframe.model import ClassDef, Graph, Lit, Prop, Schema
from tripleframe.operators import documents as docs
from tripleframe.operators import match, update, validate, versions
from tripleframe.session import cut, release, scratch_path
from tripleframe.sources import csv, flatten, triples
from tripleframe.sources import json as json_lines
from tripleframe.streaming import documents as streams

SCHEMA = Schema(
    [
        ClassDef("Team", kind="enum", values=("IT", "Marketing")),
        ClassDef("Country", (Prop("name", "xsd:string"),), key="Lexical", key_fields=("name",)),
        ClassDef("Address", (Prop("street", "xsd:string"), Prop("country", "Country")), subdocument=True),
        ClassDef("Person", (Prop("name", "xsd:string"), Prop("age", "xsd:integer"), Prop("friend_of", "Person", "set"))),
        ClassDef(
            "Employee",
            (
                Prop("address_of", "Address"),
                Prop("contact_number", "xsd:string", "optional"),
                Prop("managed_by", "Employee"),
                Prop("member_of", "Team"),
            ),
            parents=("Person",),
        ),
        ClassDef("Shape", abstract=True),
        ClassDef("Contact", (Prop("local", "xsd:integer"), Prop("abroad", "xsd:string")), kind="union"),
    ]
)


@pytest.fixture(scope="module")
def people(spark):
    data = [
        ("Employee/1", ("Main St", "Country/UK"), None, "Employee/2", "IT", "Ann", 30, ["Person/9", "Person/8"]),
        ("Employee/2", None, "555", None, "Marketing", "Bob", None, []),
    ]
    kind = SCHEMA.struct("Employee")
    order = ["id", "address_of", "contact_number", "managed_by", "member_of", "name", "age", "friend_of"]
    return spark.createDataFrame([dict(zip(order, d)) for d in data], kind)


def test_class_frame_includes_inherited_properties():
    frame = SCHEMA.class_frame("Employee")
    assert frame["name"] == "xsd:string" and frame["contact_number"] == {"@type": "Optional", "@class": "xsd:string"}
    assert SCHEMA.class_frame("Team") == {"@type": "Enum", "@values": ["IT", "Marketing"]}
    assert SCHEMA.ancestors("Employee") == ["Employee", "Person"]
    assert set(SCHEMA.existing_classes()) == {"Team", "Country", "Address", "Person", "Employee", "Shape", "Contact"}


def test_facts_of_nested_documents(people):
    facts = rows(docs.triplify(people, SCHEMA, "Employee").select("s", "p", "o", "o_kind", "o_type").where("s like 'Employee/1%'"))
    sub = "Employee/1/address_of"
    want = [
        ("Employee/1", "rdf:type", "Employee", "node", None),
        ("Employee/1", "address_of", sub, "node", None),
        (sub, "rdf:type", "Address", "node", None),
        (sub, "street", "Main St", "data", "xsd:string"),
        (sub, "country", "Country/UK", "node", None),
        ("Employee/1", "managed_by", "Employee/2", "node", None),
        ("Employee/1", "member_of", "IT", "data", "xsd:string"),
        ("Employee/1", "name", "Ann", "data", "xsd:string"),
        ("Employee/1", "age", "30", "data", "xsd:integer"),
        ("Employee/1", "friend_of", "Person/8", "node", None),
        ("Employee/1", "friend_of", "Person/9", "node", None),
    ]
    assert facts == sorted(want, key=repr)


def test_facts_to_documents_and_back(spark):
    people = spark.createDataFrame([("Person/1", "Ann", 30, ["b", "a"]), ("Person/2", None, None, [])], SCHEMA.struct("Person"))
    back = docs.assemble_documents(docs.triplify(people, SCHEMA, "Person"), SCHEMA, "Person")
    assert rows(back) == [("Person/1", "Ann", 30, ["a", "b"]), ("Person/2", None, None, [])]


def test_match_on_facts_and_tables_agree(people):
    tables = Graph({"Employee": people}, SCHEMA)
    facts = Graph({}, SCHEMA, docs.triplify(people, SCHEMA, "Employee"))
    for pattern in (("v:s", "name", "v:o"), ("v:s", "friend_of", "v:o"), ("v:s", "member_of", "IT"), ("v:s", "rdf:type", "v:o")):
        if pattern[1] != "rdf:type":
            assert rows(match.triple(tables, *pattern)) == rows(match.triple(facts, *pattern))
    assert rows(match.triple_slice(facts, "v:s", "age", "v:o", 10, 31)) == [("Employee/1", 30.0)]
    assert rows(match.triple_slice(tables, "v:s", "age", "v:o", 31, 40)) == []
    assert match.triple(tables, "v:s", "no_such_property", "v:o").count() == 0
    with pytest.raises(ValueError):
        match.quad(tables, "v:s", "name", "v:o", None)


def test_next_and_previous_values(spark):
    g = Graph({"P": spark.createDataFrame([("a", 1), ("a", 5), ("a", 5), ("a", 9), ("b", 3)], "id string, v bigint")})
    assert rows(match.triple_next(g, "v:s", "v", "v:x", "v:n")) == [("a", 1, 5), ("a", 5, 9)]
    assert rows(match.triple_next(g, "v:s", "v", "v:x", "v:n")) == [("a", 1, 5), ("a", 5, 9)]
    assert rows(match.triple_next(g, "v:s", "v", 3, "v:n")) == [("a", 5)]
    assert rows(match.triple_next(g, "v:s", "v", "v:x", 9)) == [("a", 5), ("b", 3)]
    assert rows(match.triple_previous(g, "v:s", "v", "v:x", "v:n")) == [("a", 5, 1), ("a", 9, 5)]
    assert rows(match.triple_previous(g, "v:s", "v", 9, "v:n")) == [("a", 5), ("b", 3)]
    assert rows(match.triple_previous(g, "a", "v", "v:x", 1)) == [(5,)]


def test_templates(people):
    found = docs.query_document(people, {"@type": "Employee", "address_of": {"country": "Country/UK"}, "friend_of": ["Person/9"]})
    assert [r.id for r in found.collect()] == ["Employee/1"]
    assert rows(docs.query_document(people, docs.parse_template(SCHEMA, "Employee", ["age=30", 'name="Ann"'])).select("id")) == rows(
        people.where("age = 30 and name = 'Ann'").select("id")
    )
    with pytest.raises(ValueError):
        docs.parse_template(SCHEMA, "Employee", ["size=3"])
    assert docs.has_doc(people, "Employee/1") and not docs.has_doc(people, "Employee/7")


def test_batches(spark):
    table = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, v string")
    batch = spark.createDataFrame([("2", "B"), ("3", "C")], "id string, v string")
    assert rows(docs.insert_document(table, batch)) == [("1", "a"), ("2", "b"), ("3", "C")]
    assert rows(docs.insert_document(table, batch, full_replace=True)) == rows(batch)
    assert rows(docs.existing_ids(table, batch)) == [("2",)]
    twice = spark.createDataFrame([("2", "z"), ("3", "d"), ("3", "c")], "id string, v string")
    assert rows(docs.insert_conflicts(table, twice)) == [("2", "exists"), ("3", "repeated")]
    assert rows(docs.insert_document(table, twice)) == [("1", "a"), ("2", "b"), ("3", "c")]
    assert rows(docs.update_document(table, twice)) == [("1", "a"), ("2", "z"), ("3", "c")]
    assert rows(docs.replace_document(table, batch)) == [("1", "a"), ("2", "B")]
    assert rows(docs.update_document(table, batch)) == [("1", "a"), ("2", "B"), ("3", "C")]
    assert rows(docs.delete_document(table, batch)) == [("1", "a")]
    refs = spark.createDataFrame([("1", "x", None), ("2", None, "x"), ("3", None, "Other/1")], "id string, capture string, ref string")
    assert rows(docs.resolve_references(refs, ["ref"])) == [("1", None), ("2", "1"), ("3", "Other/1")]


def test_changes_are_a_set(spark, people):
    facts = docs.triplify(people, SCHEMA, "Employee")
    ann = people.where("name = 'Ann'")
    add = update.add_triple(ann, "v:id", "name", Lit("Ann"))
    assert rows(update.apply_changes(facts, add)) == rows(facts)
    assert tuple(update.change_counts(facts, add).first()) == (0, 0)
    gone = update.delete_triple(ann, "v:id", "no", Lit("x"))
    assert rows(update.apply_changes(facts, gone)) == rows(facts)
    both = update.add_triple(ann, "v:id", "x", Lit(1), seq=1).unionByName(update.delete_triple(ann, "v:id", "x", Lit(1), seq=2))
    assert rows(update.apply_changes(facts, both)) == rows(facts)
    assert versions.squash(both, facts).count() == 0 and versions.squash(both).count() == 1
    # Operations without effect on the base: a known fact added and then removed is gone, as in a replay.
    known = update.add_triple(ann, "v:id", "name", Lit("Ann"), seq=1).unionByName(update.delete_triple(ann, "v:id", "name", Lit("Ann"), seq=2))
    assert rows(versions.rebase(facts, known)) == rows(versions.snapshot(facts, known, 2)) != rows(facts)
    assert [r.op for r in versions.squash(known, facts).collect()] == ["-"]
    new = update.update_triple(facts, ann, "v:id", "name", Lit("Anna"))
    after = update.apply_changes(facts, new)
    assert [r.o for r in after.where("s = 'Employee/1' and p = 'name'").collect()] == ["Anna"]
    assert tuple(update.change_counts(facts, new).first()) == (1, 1)
    node = update.apply_changes(facts, update.add_triple(ann, "v:id", "knows", "Person/3"))
    assert node.where("p = 'knows'").first()["o_kind"] == "node"


def doc(spark, *rows_):
    return spark.createDataFrame(list(rows_), "id string, name string, age bigint, at struct<city:string,zip:array<string>>")


def test_diff_and_patch(spark):
    before = doc(spark, ("Person/Jane", "Jane", 18, ("A", ["1", "2"])), ("Person/Al", "Al", 5, None), ("Person/Bo", "Bo", 1, None))
    after = doc(spark, ("Person/Jane", "Janine", 18, ("B", ["2", "1"])), ("Person/Al", "Al", None, None), ("Person/Cy", "Cy", 2, None))
    diff = versions.diff_object(before, after, sets=["at.zip"])
    assert rows(diff) == sorted(
        [("Person/Jane", "name", "Jane", "Janine"), ("Person/Jane", "at.city", "A", "B"), ("Person/Al", "age", "5", None)], key=repr
    )
    assert versions.diff_object(before, after).where("path = 'at.zip'").count() == 1
    full = versions.diff_object(before, after)
    common = after.where("id <> 'Person/Cy'").unionByName(before.where("id = 'Person/Bo'"))
    assert rows(versions.patch(before, full)) == rows(common)
    ops = {r.id: (r.op, json.loads(r.body)) for r in versions.diff_version(before, after).collect()}
    assert ops["Person/Cy"][0] == "@insert" and ops["Person/Bo"][0] == "@delete"
    assert ops["Person/Jane"][1]["name"] == {"@op": "SwapValue", "@before": "Jane", "@after": "Janine"}
    bodies = versions.patch_json(full, before.schema)
    assert rows(versions.read_patch(bodies, before.schema)) == rows(full)
    update_ = {r.id: json.loads(r.update) for r in versions.patch_update(full, before.schema).collect()}
    assert update_["Person/Al"] == {}
    assert update_["Person/Jane"] == {"name": "Janine", "at": {"city": "B", "zip": ["2", "1"]}}


def test_swap_value_shape(spark):
    a = spark.createDataFrame([("d", "wew")], "id string, test string")
    b = spark.createDataFrame([("d", "wow")], "id string, test string")
    body = json.loads(versions.diff_version(a, b).first()["body"])
    assert body == {"test": {"@before": "wew", "@after": "wow", "@op": "SwapValue"}}


def test_conflicting_documents_stay_whole(spark):
    before = doc(spark, ("1", "a", 1, None), ("2", "a", 1, None))
    after = doc(spark, ("1", "b", 2, None), ("2", "b", 2, None))
    stored = doc(spark, ("1", "z", 1, None), ("2", "b", 1, None))
    diff = versions.diff_object(before, after)
    assert rows(versions.patch_conflicts(stored, diff)) == [("1", "name", "z", "a", "b")]
    assert rows(versions.patch_resource(stored, diff)) == rows(doc(spark, ("1", "z", 1, None), ("2", "b", 2, None)))
    assert rows(versions.patched_ids(stored, diff)) == [("2",)]
    assert versions.patch_conflicts(stored, diff, match_final_state=False).count() == 2


def test_apply_takes_over_a_branch(spark):
    main = doc(spark, ("P/Socrates", "Socrates", 1, None))
    changes = doc(spark, ("P/Socrates", "Socrates", 1, None), ("P/Plato", "Plato", 2, None), ("P/Aristotle", "Aristotle", 3, None))
    diff = versions.diff_version(main, changes)
    assert [r.op for r in diff.collect()] == ["@insert", "@insert"]
    merged = versions.apply_difference(main, changes, main)
    assert versions.diff_version(merged, changes).count() == 0
    assert versions.apply_conflicts(main, changes, main).count() == 0


def test_history(spark):
    ts = dt.datetime(2024, 1, 1)
    commits = spark.createDataFrame([(f"c{i}", "me", f"m{i}", ts + dt.timedelta(days=i), i) for i in range(5)], "commit_id string, author string, message string, ts timestamp_ntz, seq bigint")
    touched = spark.createDataFrame([("c0", "d"), ("c2", "d"), ("c2", "d"), ("c4", "d"), ("c1", "e")], "commit_id string, doc_id string")
    assert [r.commit_id for r in versions.log(commits).collect()] == ["c4", "c3", "c2", "c1", "c0"]
    assert [r.commit_id for r in versions.log(commits, 1, 2).collect()] == ["c3", "c2"]
    assert sorted(r.commit_id for r in versions.log(commits, 3).collect()) == ["c0", "c1"]
    assert versions.commit_history(commits, 2).count() == 2
    with pytest.raises(ValueError):
        versions.commit_history(commits, -1)
    page = versions.document_history(touched, commits, start=1, count=1)
    assert [(r.doc_id, r.commit_id) for r in page.collect()] == [("d", "c2")]
    times = {r.doc_id: (r.created.day, r.updated.day) for r in versions.document_times(touched, commits).collect()}
    assert times == {"d": (1, 5), "e": (2, 2)}


def test_validation(spark, people):
    found = rows(validate.validate_documents(people, SCHEMA, "Employee"))
    assert found == sorted(
        [("Employee/2", "address_of", "required", None), ("Employee/2", "managed_by", "required", None), ("Employee/2", "age", "required", None)], key=repr
    )
    shapes = spark.createDataFrame([("s",)], "id string")
    assert rows(validate.validate_documents(shapes, SCHEMA, "Shape")) == [("s", "@type", "abstract", "Shape")]
    contacts = spark.createDataFrame([("1", 5, None), ("2", 5, "x"), ("3", None, None)], "id string, local bigint, abroad string")
    assert [r[0] for r in rows(validate.validate_documents(contacts, SCHEMA, "Contact"))] == ["2", "3"]
    tagged = Schema([ClassDef("T", (Prop("n", "xsd:unsignedByte", "set"),))])
    sets = spark.createDataFrame([("1", [1, 2]), ("2", [1, 300])], "id string, n array<int>")
    assert rows(validate.validate_documents(sets, tagged, "T")) == [("2", "n", "element", "[300]")]
    lexical = spark.createDataFrame([("Country/U%20K", "U K"), ("Other/1", "F")], "id string, name string")
    assert rows(validate.validate_documents(lexical, SCHEMA, "Country")) == [("Other/1", "@id", "key", "Other/1")]
    refs = validate.dangling_references(people, "friend_of", spark.createDataFrame([("Person/9",)], "id string"))
    assert rows(refs) == [("Employee/1", "friend_of", "reference", "Person/8")]


def test_csv_import(spark, tmp_path):
    file = tmp_path / "class_grades.csv"
    file.write_text('Last Name,Test.1,Grade\nAda,40.5,"A ""plus"""\nBob,,B\n')
    table, definition = csv.import_csv(spark, str(file))
    assert definition.name == "ClassGrades" and [(x.name, x.range) for x in definition.props][1] == ("test_1", "xsd:double")
    assert rows(table) == [("ClassGrades/Ada_40.5_A%20%22plus%22", "Ada", 40.5, 'A "plus"')]
    with pytest.raises(ValueError):
        csv.import_csv(spark, str(file), na="error")
    with pytest.raises(ValueError):
        csv.import_csv(spark, str(file), na="optional", keys=["test_1"])
    with pytest.raises(ValueError):
        csv.import_csv(spark, str(file), id_="nope")
    loose, definition = csv.import_csv(spark, str(file), na="optional")
    assert loose.count() == 2 and {x.kind for x in definition.props} == {"optional"}
    named, _ = csv.import_csv(spark, str(file), id_="last_name", embedded=["grade"], class_name="G")
    assert rows(named) == [("G/Ada", "Ada", 40.5, 'G/A "plus"')]


def test_flatten(spark, people):
    tables = {"Employee": people, "Country": spark.createDataFrame([("Country/UK", "UK")], "id string, name string")}
    flat = flatten.flatten_documents(people, SCHEMA, "Employee", tables, 2)
    assert "managed_by" in flat.columns and flat.columns[0] == "Document id"
    orders = Schema([ClassDef("A", (Prop("b", "B"),)), ClassDef("B", (Prop("c", "C"), Prop("n", "xsd:string"))), ClassDef("C", (Prop("n", "xsd:string"),))])
    a = spark.createDataFrame([("A/1", "B/1"), ("A/2", None)], "id string, b string")
    b = spark.createDataFrame([("B/1", "C/1", "x")], "id string, c string, n string")
    c = spark.createDataFrame([("C/1", "y")], "id string, n string")
    held = {"A": a, "B": b, "C": c}
    assert flatten.flatten_documents(a, orders, "A", held, 1).columns == ["Document id", "b.c", "b.n"]
    deep = flatten.flatten_documents(a, orders, "A", held, 5)
    assert deep.columns == ["Document id", "b.c.n", "b.n"] and rows(deep) == [("A/1", "y", "x"), ("A/2", None, None)]
    kept = flatten.flatten_documents(a, orders, "A", held, 1, keepid=True)
    assert kept.columns == ["@id", "@type", "b.@id", "b.@type", "b.c", "b.n"]
    nested = spark.createDataFrame([("A/1", ("S/1", "t", "x"))], "id string, s struct<`@id`:string,`@type`:string,v:string>")
    assert flatten.flatten_documents(nested, orders, "A").columns == ["Document id", "s.v"]
    with pytest.raises(ValueError):
        flatten.flatten_documents(a, orders, "A", None, 1)
    with pytest.raises(ValueError):
        flatten.flatten_documents(a, orders, "Z", held, 1)


def test_ntriples(spark):
    odd = 'tab\t quote" back\\slash \\n new\nline'
    quads = spark.createDataFrame(
        [("instance", "a", "p", odd, "data", "xsd:string"), ("instance", "a", "p", "", "data", "xsd:string"), ("instance", "a", "q", "b", "node", None)],
        "graph string, s string, p string, o string, o_kind string, o_type string",
    )
    lines = triples.to_ntriples(quads)
    assert rows(triples.from_ntriples(lines).select(*quads.columns)) == rows(quads)
    text = spark.createDataFrame([("# note",), ("",), ('<a> <p> "x"@en .',), ("junk",)], "value string")
    assert rows(triples.from_ntriples(text).select("o", "o_type")) == [("x", "@en")]
    assert rows(triples.bad_lines(text)) == [("junk",)]
    odd = spark.createDataFrame([('_:a <p> "chat"@fr .',), ("<s> <p> _:a . # note",), ('<s> <p> <> .',), ('<s> <p> "" .',)], "value string")
    held = triples.from_ntriples(odd)
    assert rows(held.select("s", "o", "o_kind", "o_type")) == sorted(
        [("_:a", "chat", "data", "@fr"), ("s", "_:a", "node", None), ("s", "", "node", None), ("s", "", "data", "xsd:string")], key=repr
    )
    assert rows(triples.from_ntriples(triples.to_ntriples(held))) == rows(held) and triples.bad_lines(odd).count() == 0
    iris = spark.createDataFrame([("type",), ("xsd:date",), ("other:x",), ("plain",)], "i string")
    full = iris.select("i", triples.expand(F.col("i"), triples.PREFIXES, triples.SHORT_NAMES).alias("f"))
    back = {r.i: r.b for r in full.select("i", triples.compact(F.col("f"), triples.PREFIXES).alias("b")).collect()}
    assert back == {"type": "rdf:type", "xsd:date": "xsd:date", "other:x": "other:x", "plain": "plain"}


def test_json_lines_and_streams(spark, tmp_path):
    schema = "id string, n bigint"
    good = spark.createDataFrame([("a", 1), ("b", 2)], schema)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.json").write_text('{"id":"a","n":1}\n{"id":"b","n":2}\n{broken\n')
    read = json_lines.read_documents(spark, str(tmp_path / "in"), good.schema)
    assert rows(read.where("_corrupt_record is null").drop("_corrupt_record")) == rows(good)
    assert [r["_corrupt_record"] for r in read.where("_corrupt_record is not null").collect()] == ["{broken"]
    lines = spark.createDataFrame([('{"a":1} {"a":2}{"a":"} {"}',), ('{"a":3}{"a":4}',)], "value string")
    assert json_lines.split_objects(lines).count() == 3
    (tmp_path / "good").mkdir()
    json_lines.write_documents(good, str(tmp_path / "good" / "part"))
    stream = streams.stream_documents(spark, str(tmp_path / "good" / "part"), good.schema, max_files=1)
    for _ in range(2):
        streams.append_documents(stream, str(tmp_path / "table"), str(tmp_path / "mark"))
    assert rows(spark.read.parquet(str(tmp_path / "table"))) == rows(good)
    records = [json.loads(line) for line in streams.deliver(good.orderBy("id"))]
    assert records[0] == {"@type": "PrefaceRecord", "names": ["id", "n"]}
    assert records[1] == {"@type": "Binding", "id": "a", "n": 1} and records[-1]["@type"] == "PostscriptRecord"


def test_cut_tables_live_until_release(spark):
    table = cut(spark.range(5))
    assert table.count() == 5 and "tripleframe" in scratch_path(spark)
    release(spark)
    with pytest.raises(Exception):
        spark.read.parquet(table.inputFiles()[0]).count()


NESTED = Schema(
    [
        ClassDef("Point", (Prop("x", "xsd:double"), Prop("marks", "xsd:string", "list")), subdocument=True),
        ClassDef("Ring", (Prop("name", "xsd:string"), Prop("points", "Point", "list"), Prop("tags", "xsd:integer", "set")), subdocument=True),
        ClassDef("Label", (Prop("text", "xsd:string"), Prop("at", "Point")), subdocument=True),
        ClassDef(
            "Country",
            (Prop("perimeter", "Point", "list"), Prop("holes", "Ring", "set"), Prop("label", "Label", "optional"), Prop("near", "Country", "list")),
        ),
    ]
)


def test_collections_of_nested_documents(spark):
    point = lambda x, marks=None: (x, marks)
    data = [
        ("Country/1", [point(1.5, ["a", "a"]), None, point(None, []), point(1.5, ["a", "a"])], [], None, ["Country/2", "Country/2"]),
        ("Country/2", [], [("r", [], [1, 2]), ("s", None, []), ("t", [point(2.0), None], [7])], ("L", point(0.1, ["m"])), []),
        ("Country/3", None, [(None, None, [])], (None, None), None),
        ("Country/4", [None], [], ("M", point(None)), [None]),
    ]
    table = spark.createDataFrame(data, NESTED.struct("Country"))
    facts = docs.triplify(table, NESTED, "Country", lists=True)
    assert rows(docs.assemble_documents(facts, NESTED, "Country")) == rows(table)
    # A list on its own gives the same facts.
    alone = docs.list_facts(table, "perimeter", schema=NESTED, cls="Country")
    assert rows(alone) == rows(facts.where("s like '%/perimeter/%' or p = 'perimeter'"))
    assert facts.where("s like 'Country/3%' and p = 'perimeter'").count() == 0
    assert rows(facts.where("s = 'Country/2' and p = 'perimeter'").select("o", "o_kind")) == [("rdf:nil", "node")]
    near = facts.where("s like 'Country/1/near/%' and p = 'rdf:first'").select("o", "o_kind")
    assert rows(near) == [("Country/2", "node"), ("Country/2", "node")]


def test_collections_with_missing_nested_documents(spark):
    table = spark.createDataFrame(
        [("Country/1", [(1.0, None), (2.0, None)], [("r", None, []), ("s", None, [])], ("L", None), None)], NESTED.struct("Country")
    )
    facts = docs.triplify(table, NESTED, "Country", lists=True)
    lost = facts.where("s not in ('Country/1/perimeter/0/item', 'Country/1/holes/0', 'Country/1/label')")
    assert rows(docs.assemble_documents(lost, NESTED, "Country")) == [
        ("Country/1", [None, (2.0, None)], [("s", None, [])], None, None)
    ]
    assert rows(docs.assemble_documents(facts.where("false"), NESTED, "Country")) == []


def test_unfolded_documents(spark):
    schema = Schema(
        [
            ClassDef("City", (Prop("name", "xsd:string"),)),
            ClassDef("Home", (Prop("city", "City"),), subdocument=True),
            ClassDef("Person", (Prop("boss", "Person"), Prop("home", "Home"), Prop("friends", "Person", "set"))),
            ClassDef("Clerk", (Prop("desk", "xsd:integer"),), parents=("Person",)),
        ]
    )
    people = spark.createDataFrame(
        [
            ("Person/1", "Person/2", ("City/1",), ["Person/1", "Clerk/1"]),
            ("Person/2", "Person/1", (None,), []),
            ("Person/3", "Person/9", None, None),
        ],
        schema.struct("Person"),
    )
    clerks = spark.createDataFrame([("Clerk/1", 7, "Clerk/1", None, None)], schema.struct("Clerk"))
    cities = spark.createDataFrame([("City/1", "Rome")], schema.struct("City"))
    tables = {"Person": people, "Clerk": clerks, "City": cities}
    body = lambda **more: {r.id: json.loads(r.body) for r in docs.all_documents(tables, schema=schema, **more).collect()}
    once = body(unfolded=1)
    assert once["Person/1"] == {
        "id": "Person/1",
        "boss": {"id": "Person/2", "boss": "Person/1", "home": {}, "friends": []},
        "home": {"city": {"id": "City/1", "name": "Rome"}},
        "friends": [{"id": "Person/1"}, {"id": "Clerk/1", "desk": 7, "boss": "Clerk/1"}],
    }
    assert once["Person/3"] == {"id": "Person/3", "boss": {"id": "Person/9"}}
    assert once["Clerk/1"]["boss"] == {"id": "Clerk/1"}
    deep = body(unfolded=3)
    assert deep["Person/1"]["boss"] == {"id": "Person/2", "boss": {"id": "Person/1"}, "home": {}, "friends": []}
    assert deep["Person/2"]["boss"]["home"] == {"city": {"id": "City/1", "name": "Rome"}}
    assert deep["Person/2"]["boss"]["boss"] == {"id": "Person/2"}
    assert body() == {r.id: json.loads(r.body) for r in docs.all_documents(tables).collect()}
    spaces = {"@base": "http://d/", "c": "http://d/City/", "p": "http://p/"}
    full = body(unfolded=1, prefixes=spaces, prefixed=False)
    assert full["http://d/Person/1"]["home"] == {"city": {"id": "http://d/City/1", "name": "Rome"}}
    assert full["http://d/Person/3"]["boss"] == {"id": "http://d/Person/9"}
    short = body(unfolded=1, prefixes=spaces)
    assert short["Person/1"] == once["Person/1"]
    wide = docs.with_prefixes(people, schema, "Person", spaces, prefixed=False)
    back = docs.with_prefixes(wide, schema, "Person", spaces).where("id = 'Person/1'").first()
    assert back.home.city == "c:1" and back.boss == "Person/2" and back.friends == ["Person/1", "Clerk/1"]


def test_datatypes_of_text_columns(spark):
    """Each column takes the first datatype all its values have in common, whatever part of the table they are in."""
    from tripleframe.operators import validate

    held = {
        "whole": (["1", " -7 ", None], "xsd:integer"), "double": (["1", "2.5", "1e3"], "xsd:double"), "point": (["1.0", "2.", "3"], "xsd:double"),
        "decimal": (["12345678901234567890", "1.5", "0"], "xsd:decimal"), "huge": (["1" * 40, "1.5", "2"], "xsd:double"),
        "day": (["2020-02-29", "1999-12-31", None], "xsd:date"), "moment": (["2020-02-29", "2020-02-29T01:02:03", None], "xsd:dateTime"),
        "noday": (["2021-02-29", "2020-01-01", None], "xsd:string"), "lasts": (["P1Y2M", "PT0.5S", "-P3DT4H"], "xsd:duration"), "p": (["P", "PT", "P1D"], "xsd:string"),
        "flag": (["true", "false", None], "xsd:boolean"), "mixed": (["1", "P1D", "x"], "xsd:string"), "none": ([None, None, None], "xsd:string"),
    }
    rows_ = list(zip(*[v for v, _ in held.values()], strict=True))
    df = spark.createDataFrame(rows_, ", ".join(f"{c} string" for c in held)).repartition(3)
    found = validate.profile(df)
    assert found.ranges == {c: r for c, (_, r) in held.items()}
    assert found.nulls == {c for c, (v, _) in held.items() if None in v} and found.rows == 3
    typed = df.selectExpr("make_dt_interval(1) as d", "cast('2020-01-01' as date) as e", "1.5BD as f")
    assert list(validate.profile(typed).ranges.values()) == ["xsd:duration", "xsd:date", "xsd:decimal"]
    assert validate.profile(df.where("false")).ranges == dict.fromkeys(held, "xsd:string")
    definition = validate.infer_class(df, "A", keys=["whole"], na_mode="optional", embedded=["p"])
    assert [(p.range, p.kind) for p in definition.props][:1] == [("xsd:integer", "required")]
    assert next(p for p in definition.props if p.name == "p").range == "A"

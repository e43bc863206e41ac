import json

import pytest
from pyspark.sql import functions as F

from tidegraph.functions import sparql as S
from tidegraph.operators import temporal
from tidegraph.sources import ndjson, rdf, results
from tidegraph.streaming import imports

XSD = "http://www.w3.org/2001/XMLSchema#"


def one(spark, *columns):
    return tuple(spark.range(1).select(*(c.alias(f"c{i}") for i, c in enumerate(columns))).first())


def test_statements_of_all_kinds(spark):
    lines = [
        "<http://s> <http://p> <http://o> .",
        '<http://s> <http://p> "a \\"quoted\\" text"@en-GB <http://g> . # comment',
        f'_:b <http://p> "1"^^<{XSD}integer> .',
        "# only a comment",
        "",
        "<http://s> <http://p> .",
    ]
    frame = spark.createDataFrame([(x,) for x in lines], "value string")
    got = {tuple(r) for r in rdf.parse(frame).collect()}
    assert got == {
        ("<http://s>", "<http://p>", "<http://o>", None),
        ("<http://s>", "<http://p>", '"a \\"quoted\\" text"@en-gb', "<http://g>"),
        ("_:b", "<http://p>", f'"1"^^<{XSD}integer>', None),
    }
    with pytest.raises(Exception, match="not a statement"):
        rdf.parse(frame, strict=True).collect()
    one_scope, other = (rdf.parse(frame, scope=s).where("s LIKE '\\\\_:%'").first().s for s in ("x", "y"))
    assert one_scope != other and one_scope.startswith("_:") and one_scope.endswith("_b")
    counts = rdf.counts(rdf.parse(frame.unionByName(frame.limit(1)), graph_uri="http://g")).first()
    assert tuple(counts) == (4, 2, 2, 1, 1)


def test_quads_round_trip(spark, tmp_path):
    edges = spark.createDataFrame([("A/1", "r", "B/2"), ("A/1", "s", "B/3")], "src string, relation string, dst string")
    quads = rdf.from_edges(edges).withColumn("g", F.lit("<http://g>"))
    rdf.write(quads, f"{tmp_path}/q")
    assert sorted(rdf.read(spark, f"{tmp_path}/q", strict=True).collect()) == sorted(quads.collect())


def write_lines(path, *lines):
    path.write_text("".join(x if isinstance(x, str) else json.dumps(x) + "\n" for x in lines))


def test_long_literals_and_canonical_terms(spark):
    text = "ab\\\\\\n" * 200_000
    lines = [f'<http://s> <http://p> "{text}" .', r'<http://s> <http://p/\u00e9> "\u0041\U0001F600\t\"q\"\\"@EN-gb .', f'<http://s> <http://p> "x"^^<{XSD}string> .']
    got = [tuple(r)[1:3] for r in rdf.parse(spark.createDataFrame([(x,) for x in lines], "value string"), strict=True).collect()]
    assert got[0] == ("<http://p>", f'"{text}"')
    assert got[1] == ("<http://p/é>", '"A😀\t\\"q\\"\\\\"@en-gb')
    assert got[2] == ("<http://p>", '"x"')
    assert one(spark, S.lexical(F.lit(got[1][1])), F.length(S.lexical(F.lit(got[1][1])))) == ('A😀\t"q"\\', 7)


def test_term_constructors(spark):
    assert one(spark, S.iri(F.lit("a b"), "http://x/"), S.iri(F.lit("ab"), "http://x/"), S.iri(F.lit("urn:y"), "http://x/")) == (None, "<http://x/ab>", "<urn:y>")
    assert one(spark, S.str_dt(F.lit('1"'), XSD + "decimal"), S.str_lang(F.lit("a"), "EN"), S.str_lang(F.lit("a"), "")) == (f'"1\\""^^<{XSD}decimal>', '"a"@en', None)
    one_node, same, other = one(spark, S.bnode(F.lit("a")), S.bnode(F.lit("a")), S.bnode(F.lit("b")))
    assert one_node == same != other and one_node.startswith("_:")
    assert one(spark, S.same_term(F.lit('"\\u0041"@EN'), F.lit('"A"@en')), S.same_term(F.lit('"A"'), F.lit('"A"@en'))) == (True, False)


def test_results_leave_unbound_variables_out(spark):
    terms = spark.createDataFrame([("<http://x>", None), ("_:b", '"a\\nb"@en'), (None, f'"1"^^<{XSD}integer>')], "x string, y string")
    got = [json.loads(r.value) for r in results.bindings(terms).collect()]
    assert got == [{"x": {"type": "uri", "value": "http://x"}}, {"x": {"type": "bnode", "value": "b"}, "y": {"type": "literal", "value": "a\nb", "xml:lang": "en"}}, {"y": {"type": "literal", "value": "1", "datatype": XSD + "integer"}}]
    assert [json.loads(r.value) for r in results.rows(terms).collect()][0] == {"x": "<http://x>"}
    assert [tuple(r) for r in results.read(results.bindings(terms), ["x", "y"]).collect()] == [("http://x", None), ("b", "a\nb"), (None, "1")]


TRIPLET = {"source": {"type": "P", "name": "Ann", "key": "1"}, "relation": "knows", "target": {"type": "P", "name": "Bob"}, "evidence": "said so", "properties": {"since": 1999}}
ENTITY = {"type": "P", "name": "Ann", "key": "1", "properties": {"age": 52, "ok": True, "nick": "52", "x": 1.5, "none": None}}


def test_ndjson_grammar(spark, tmp_path):
    write_lines(tmp_path / "x.json", TRIPLET, ENTITY, {"type": "P", "name": "Bare"}, "not json\n", {"name": "no type"})
    lines = ndjson.read(spark, str(tmp_path))
    assert [(r.src, r.relation, r.dst, r.src_name, r.evidence, json.loads(r.properties)) for r in ndjson.triplets(lines).collect()] == [("P/1", "knows", "P/Bob", "Ann", "said so", {"since": 1999})]
    assert {r.id: r.properties and json.loads(r.properties) for r in ndjson.entities(lines).collect()} == {"P/1": ENTITY["properties"], "P/Bare": None}
    assert {r.field: (r.kind, r.value) for r in ndjson.fields(ndjson.entities(lines)).collect()} == {"age": ("long", "52"), "ok": ("boolean", "true"), "nick": ("string", "52"), "x": ("double", "1.5"), "none": ("json", None)}
    assert sorted((r.malformed, r.line) for r in ndjson.rejected(lines).collect()) == [(False, '{"name":"no type"}'), (True, "not json")]
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        ndjson.read(spark, str(tmp_path), strict=True).collect()


def test_ndjson_keeps_keys_names_evidence_and_properties(spark, tmp_path):
    edges = spark.createDataFrame([("P/a/b", "r", "Q/1", "Ann", "Q/1", "why", '{"n":1}'), ("P/2", "r", "Q/x", None, None, None, None)], "src string, relation string, dst string, src_name string, dst_name string, evidence string, properties string")
    ndjson.write(edges, f"{tmp_path}/e")
    found = {r.src: tuple(r)[2:] for r in ndjson.triplets(ndjson.read(spark, f"{tmp_path}/e", strict=True)).collect()}
    assert found == {"P/a/b": ("Q/1", "Ann", "Q/1", "why", '{"n":1}'), "P/2": ("Q/x", "2", "x", None, None)}
    ndjson.write_entities(spark.createDataFrame([("P/a/b", "Ann", '{"n":1}')], "id string, name string, properties string"), f"{tmp_path}/n")
    assert [tuple(r) for r in ndjson.entities(ndjson.read(spark, f"{tmp_path}/n", strict=True)).collect()] == [("P/a/b", "P", "Ann", '{"n":1}')]


def test_stream_import_takes_each_file_once_and_loses_no_line(spark, tmp_path):
    inbox, target, checkpoint = (str(tmp_path / n) for n in ("inbox", "out", "checkpoint"))
    (tmp_path / "inbox").mkdir()
    write_lines(tmp_path / "inbox/a.json", TRIPLET, ENTITY, "broken\n", {"name": "no type"})
    want = {"edges": 1, "entities": 1, "malformed": 1, "unknown": 1}
    for _ in range(2):
        assert imports.wait(imports.start_import(spark, inbox, target, checkpoint, observed_at="2024-01-01T00:00:00Z"), 60) == "succeeded"
        assert imports.counts(spark, target) == want
    write_lines(tmp_path / "inbox/b.json", TRIPLET, TRIPLET)
    imports.wait(imports.start_import(spark, inbox, target, checkpoint))
    assert imports.counts(spark, target) == want | {"edges": 3}
    assert str(imports.imported(spark, target, "entities").first().observed_at) == "2024-01-01 00:00:00"


def test_strict_import_fails_and_a_stopped_one_says_so(spark, tmp_path):
    (tmp_path / "inbox").mkdir()
    write_lines(tmp_path / "inbox/a.json", TRIPLET, {"name": "no type"})
    job = imports.start_import(spark, str(tmp_path / "inbox"), str(tmp_path / "out"), str(tmp_path / "c"), strict=True)
    with pytest.raises(Exception, match="neither"):
        imports.wait(job)
    assert imports.status(job) == "failed"
    endless = spark.readStream.format("rate").load().writeStream.format("noop").start()
    job = imports.ImportJob(endless, "")
    assert imports.status(job) == "running"
    imports.cancel(job)
    assert imports.status(job) == "cancelled"


def test_stream_of_events_is_folded_batch_by_batch(spark, tmp_path):
    columns = "edge_id string, commit_seq long, event_ord int, op string"
    for batch in ([("e1", 1, 0, "assert"), ("e2", 1, 1, "assert")], [("e1", 2, 0, "retract")], [("e1", 3, 0, "assert"), ("e3", 3, 1, "assert"), ("e2", 4, 0, "retract")]):
        spark.createDataFrame(batch, columns).write.mode("append").parquet(f"{tmp_path}/log")
        events = spark.readStream.schema(columns).parquet(f"{tmp_path}/log")
        imports.start_fold(events, f"{tmp_path}/state", f"{tmp_path}/c").awaitTermination()
        want = temporal.fold(spark.read.parquet(f"{tmp_path}/log"))
        assert sorted(map(tuple, imports.folded(spark, f"{tmp_path}/state").collect())) == sorted(map(tuple, want.collect()))


def test_unique_signals_drop_replays(spark, tmp_path):
    rows = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:00:00"), (2, "2024-01-01 00:01:00")], "seq long, ts string").selectExpr("seq", "CAST(ts AS timestamp) AS ts")
    rows.write.parquet(f"{tmp_path}/in")
    stream = imports.unique_signals(spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in"))
    stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.seq for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [1, 2]


def test_read_your_writes():
    assert imports.require_seq(5, None) == imports.require_seq(5, 5) == 5
    with pytest.raises(imports.NotYetVisible):
        imports.require_seq(5, 6)
    assert (imports.read_seq(9, 5), imports.read_seq(9, 5, consistency="strong", min_indexed_seq=9)) == (5, 9)
    with pytest.raises(imports.NotYetVisible):
        imports.read_seq(9, 5, min_indexed_seq=6)


def test_string_functions(spark):
    x = F.lit("a b c")
    assert one(spark, S.strbefore(x, " "), S.strbefore(x, "z"), S.strafter(x, " "), S.strafter(x, "z"), S.strafter(F.lit(None).cast("string"), "z")) == ("a", "", "b c", "", None)
    assert one(spark, S.encode_for_uri(F.lit("a b~*/é"))) == ("a%20b~%2A%2F%C3%A9",)
    assert one(spark, *(S.lang_matches(F.lit(t), w) for t, w in (("en-GB", "EN"), ("en", "en-GB"), ("", "*"), ("de", "*")))) == (True, False, False, True)
    assert one(spark, S.regex(F.lit("A.c"), "a.c", "iq"), S.regex(F.lit("Abc"), "a.c", "iq"), S.replace(F.lit("abc"), "(b)", "<$1>")) == (True, False, "a<b>c")


def test_number_and_cast_functions(spark):
    assert one(spark, *(S.round_half_up(F.lit(v)) for v in (-2.5, 2.5, 2.4))) == (-2.0, 3.0, 2.0)
    nan = F.lit(float("nan"))
    assert one(spark, S.equals(nan, nan), S.equals(F.lit(1.0), F.lit(1.0)), S.divide(F.lit(1), F.lit(0)), S.ceil(F.lit(1.2))) == (False, True, None, 2.0)
    assert one(spark, S.cast(F.lit("1.5"), "xsd:integer"), S.cast(F.lit("1"), "xsd:boolean"), S.cast(F.lit("x"), XSD + "double")) == (None, True, None)
    assert str(one(spark, S.cast(F.lit("2024-01-01T00:00:00+02:00"), "xsd:dateTime"))[0]) == "2023-12-31 22:00:00"
    assert one(spark, S.timezone_of(F.lit("2024-01-01T00:00:00+02:00")), S.timezone_of(F.lit("2024-01-01T00:00:00"))) == ("+02:00", "")


def test_term_functions_and_order(spark):
    terms = [None, "_:b", "<http://x>", f'"10"^^<{XSD}integer>', f'"9"^^<{XSD}integer>', '"text"', '"x"@en', f'"no"^^<{XSD}integer>']
    frame = spark.createDataFrame([(t,) for t in terms], "t string")
    got = {r.t: tuple(r)[1:] for r in frame.select("t", S.lexical("t"), S.lang("t"), S.datatype("t"), S.is_numeric("t")).collect()}
    assert got['"x"@en'] == ("x", "en", "http://www.w3.org/1999/02/22-rdf-syntax-ns#langString", False)
    assert got['"text"'] == ("text", "", XSD + "string", False)
    assert got[f'"10"^^<{XSD}integer>'] == ("10", "", XSD + "integer", True)
    assert got[f'"no"^^<{XSD}integer>'][3] is False
    assert got["<http://x>"][0] == "http://x" and got["_:b"][0] is None
    ordered = [r.t for r in frame.orderBy(*S.term_order("t")).collect()]
    assert ordered[:5] == [None, "_:b", "<http://x>", f'"9"^^<{XSD}integer>', f'"10"^^<{XSD}integer>']

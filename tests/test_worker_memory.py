"""What the Python workers of an ingest hold."""

from lakewright.plans.sample_messages import event_report_format
from lakewright.sources.exports import frame_object, write_groups
from lakewright.sources.framing import read_records
from lakewright.sources.listing import read_objects
from lakewright.sources.messages import _Decoder


def test_groups_are_built_and_written_by_one_worker(spark, tmp_path):
    rows = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "k int, v string")

    def object_of(key, pdf):
        return f"events-{key[0]}.5.gz", frame_object([v.encode() for v in sorted(pdf["v"])])

    root = tmp_path / "objects"
    written = write_groups(rows, [rows["k"]], str(root), object_of)
    plan = written._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FlatMapGroupsIn") == 1 and "MapInArrow" not in plan
    sizes = {r.path.rsplit("/", 1)[1]: r.length for r in written.collect()}
    assert sizes == {f.name: f.stat().st_size for f in root.iterdir() if f.suffix == ".gz"}
    found = read_records(read_objects(spark, str(root), "events")).collect()
    assert sorted(bytes(r.record) for r in found) == [b"a", b"b", b"c"]


def test_few_parsed_messages_are_held_at_once():
    rows = [("p", i, b"", None) for i in range(10_000)] + [("p", 10_000, None, None)]
    found = list(_Decoder(event_report_format()).batches(rows))
    held = [len(files) for (files, _, _), _, _ in found]
    assert sum(held) == 10_000 and max(held) <= 5_000
    assert [x for _, _, finished in found for x in finished] == [("p", 10_000)]

"""Messages to rows, on hand-built messages."""

import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tidemark.operators import enrich, flatten
from tidemark.plans import rows as jobs
from tests.helpers import WIRE, dictionaries, event, messages, payload, plan, reverse, value

B = "202401010000"
KEY = f"{B}|h1|i0"


def rows_of(spark, *objs, options=jobs.Options(), found=None):
    rows = jobs.metric_rows(messages(spark, *objs), found or dictionaries(spark), options)
    return sorted(
        ((r.MID, r.ENV, r.APP, r.HOST, r.INSTANCE) for r in rows.collect()), key=repr
    )


def bad_of(spark, *objs):
    bad = jobs.quarantine(messages(spark, *objs))
    return sorted((r.unit, r.reason, r.raw) for r in bad.collect())


def click(env=None, app=None, host="h1", **rest):
    given = {k: v for k, v in (("environment", env), ("appname", app)) if v is not None}
    return event(metrics={f"{B}|{host}|i0": {"click": value(host=host)}}, **given, **rest)


def test_own_place_wins_and_only_a_missing_one_is_looked_up(spark):
    assert rows_of(spark, [click("dev", "shop")]) == [(2, "dev", "shop", "h1", "i0")]
    assert rows_of(spark, [click()]) == [(2, "prod", "cart", "h1", "i0")]
    assert rows_of(spark, [click("dev")]) == [(2, "dev", "cart", "h1", "i0")]
    assert rows_of(spark, [click("")]) == []
    assert rows_of(spark, [click("  ")]) == []
    assert rows_of(spark, [click(" dev ", " a ")]) == [(2, "dev", "a", "h1", "i0")]
    assert rows_of(spark, [click(host="unknown")]) == []
    assert rows_of(spark, [click("dev", host="unknown")]) == [(2, "dev", None, "unknown", "i0")]


def test_each_row_takes_the_place_of_its_own_host(spark):
    two = event(
        metrics={
            KEY: {"click": value("h1"), "error": value("h2")},
            f"{B}|h2|i0": {"click": value("h2")},
        }
    )
    assert rows_of(spark, [two]) == [
        (1, "qa", "web", "h2", "i0"), (2, "prod", "cart", "h1", "i0"), (2, "qa", "web", "h2", "i0"),
    ]


def test_unknown_names_and_empty_hosts_are_dropped(spark):
    mixed = event(
        environment="dev",
        metrics={KEY: {"view": value(), "click": value(host=""), "error": value(host=None)}},
    )
    assert rows_of(spark, [mixed]) == []
    assert bad_of(spark, [mixed]) == []


def test_keeping_all_rows_under_a_default_environment(spark):
    odd = event(metrics={KEY: {"click": value(host=None), "error": value(host="unknown")}})
    assert rows_of(spark, [odd, click("")], options=replace(jobs.KEEP_ALL, default_env="none")) == [
        (1, "none", None, "unknown", "i0"), (2, "", "cart", "h1", "i0"), (2, "none", None, None, "i0"),
    ]


def test_datasource_rows(spark):
    ds = {KEY: {"b": [{"n": 2}, {"n": 1}], "a": [{"s": 'x"y|z'}], "none": []}, f"{B}|h2|i": {}}
    got = jobs.metric_rows(messages(spark, [event(datasources=ds)]), dictionaries(spark)).collect()
    assert len(got) == 1
    row = got[0]
    assert (row.MID, row.ENV, row.APP, row.HOST, row.INSTANCE) == (5, "prod", "cart", "h1", "i0")
    assert row.RTIME == reverse(B) and row.METRIC.count is not None and row.METRIC["sum"] is None
    assert json.loads(row.METRIC["items"]) == [{"n": 1}, {"n": 2}, {"s": 'x"y|z'}]


def test_datasource_keys_that_are_too_short(spark):
    one = [{"k": 1}]
    keys = [f"{B}|h1", f"{B}|h1|", f"{B}|h1||", "|h1|i0", "202413010000|h1|i0"]
    got = bad_of(spark, [event(datasources={k: {"p": one} for k in [*keys, KEY]})])
    assert got == sorted(
        [("bucket", "bad_rowkey", k) for k in keys[:4]] + [("bucket", "bad_time", keys[4])]
    )
    assert rows_of(spark, [event(datasources={k: {"p": one} for k in [*keys, KEY]})]) == [
        (5, "prod", "cart", "h1", "i0")
    ]


def test_datasource_without_a_dictionary_name_gives_no_row(spark):
    found = dictionaries(spark, names=[("click", 2)])
    both = event(metrics={KEY: {"click": value()}}, datasources={KEY: {"p": [{"k": 1}]}})
    assert rows_of(spark, [both], found=found) == [(2, "prod", "cart", "h1", "i0")]


def test_metric_keys_need_only_a_time(spark):
    keys = {B: "bad_rowkey", "|h1|i0": "bad_rowkey", "2024|h1|i0": "bad_time"}
    good = {f"{B}|": {"click": value()}}
    wrong = {k: {"click": value(), "error": value()} for k in keys}
    both = event(metrics={**good, **wrong})
    assert rows_of(spark, [both]) == [(2, "prod", "cart", "h1", "i0")]
    assert bad_of(spark, [both]) == sorted(("bucket", r, k) for k, r in keys.items())


def test_one_bad_record_does_not_cost_its_neighbours(spark):
    good = click("dev", "shop")
    typed = {"event_id": 9, "metrics": {KEY: {"click": {"host": "h1", "count": "many"}}}}
    array = [good, None, 5, [1], {"metrics": "x"}, typed, {"event_id": "7x"}, {}, click("dev", "two")]
    assert rows_of(spark, array) == [
        (2, "dev", "shop", "h1", "i0"), (2, "dev", "two", "h1", "i0")
    ]
    assert [(u, r) for u, r, _ in bad_of(spark, array)] == [("event", "bad_event")] * 4
    carried = jobs.quarantine(messages(spark, array), WIRE)  # a text where a number is asked for
    assert [r.reason for r in carried.collect()] == ["bad_event"] * 5
    valueless = event(metrics={KEY: {"click": None, "error": value()}})
    assert bad_of(spark, [valueless]) == [("metric", "bad_metric", f"{KEY}|click")]
    assert len(rows_of(spark, [valueless])) == 1


def test_messages_that_are_no_array(spark):
    texts = ['[{"a":', "garbage", "", "null", '"text"', json.dumps(click("dev"))]
    assert bad_of(spark, *texts) == sorted(("message", "bad_json", t) for t in texts)
    assert bad_of(spark, []) == []


def test_a_message_is_one_array_and_nothing_else(spark):
    one, two = json.dumps([click("dev", "a")]), json.dumps([click("dev", "b")])
    texts = [one + two, f"{one}\n{two}", f"{one} garbage", f"{one}}} junk", f'{one},"events":{two}', f'{one},"_whole":{two}',
             f'{one}],"x":[{two}', f'{one}] ,"_whole":[{two}', f'{one}],"_end":1,"x":[1', f'{one},"_whole":{two},"_end":1', f"{one},{two}", f"{one}]", f"[{one}", f'{one},"\\u005fwhole":{two}']
    assert bad_of(spark, *texts) == sorted(("message", "bad_json", t) for t in texts)
    assert rows_of(spark, *texts) == []
    fine = [f" {one}\n", json.dumps([click("_whole", "_end")]), json.dumps([click("d\u00e9", "\u0001")])]
    assert len(rows_of(spark, *fine)) == 3 and bad_of(spark, *fine) == []


def test_members_of_one_payload_make_one_text(spark):
    import base64
    import gzip

    parts = [json.dumps([click("dev", a)]) for a in "ab"]
    whole = base64.b64encode(b"".join(gzip.compress(p.encode()) for p in parts)).decode()
    frame = spark.createDataFrame([(1, whole)], "message_id bigint, value string")
    assert [(r.reason, r.raw) for r in jobs.quarantine(frame).collect()] == [("bad_json", "".join(parts))]


def test_a_text_identifier_keeps_its_event(spark):
    named = {**click("dev", "shop"), "event_id": "a7f-uuid"}
    assert rows_of(spark, [named]) == [(2, "dev", "shop", "h1", "i0")]
    options = jobs.Options(carry=(("event_id", "string"),))
    rows = jobs.metric_rows(messages(spark, [named]), dictionaries(spark), options).collect()
    assert [r.event_id for r in rows] == ["a7f-uuid"]


def test_items_that_are_no_objects_are_set_aside(spark):
    for odd in ("abc", 1, None, [1], "{x"):
        ds = event(datasources={KEY: {"p": [{"a": 1}, odd]}}, metrics={KEY: {"click": value()}})
        assert bad_of(spark, [ds]) == [("bucket", "bad_item", KEY)]
        assert rows_of(spark, [ds]) == [(2, "prod", "cart", "h1", "i0")]


def test_of_keys_that_come_twice_the_last_counts(spark):
    one, two = (json.dumps({"click": value(total=t)}) for t in (2.0, 9.0))
    text = f'[{{"metrics":{{"{KEY}":{one},"{KEY}":{two}}}}}]'
    inner = f'[{{"metrics":{{"{KEY}":{one[:-1]},{two[1:]}}}}}]'
    for doubled in (text, inner):
        rows = jobs.metric_rows(messages(spark, doubled), dictionaries(spark)).collect()
        assert [r.METRIC["sum"] for r in rows] == [9.0]


def test_every_record_has_a_fate(spark):
    array = [click("dev"), click(host="unknown"), event(metrics={KEY: {"view": value()}}), 5]
    found = jobs.fates(messages(spark, array, "["), dictionaries(spark))
    counts = {r.fate: r["count"] for r in found.groupBy("fate").count().collect()}
    assert counts == {"kept": 1, "no_place": 1, "unknown_name": 1, "bad_event": 1, "bad_json": 1}


def test_a_row_without_its_place_is_not_dropped_unseen(spark):
    rows = jobs.metric_rows(messages(spark, [click(host="unknown")]), dictionaries(spark), jobs.KEEP_ALL)
    with pytest.raises(Exception, match="a row without ENV"):
        enrich.as_rows(rows).collect()


def test_a_large_dictionary_keeps_texts_out_of_the_shuffles(spark):
    found = dictionaries(spark)
    large = replace(found, metrics=replace(found.metrics, small=False), hosts=replace(found.hosts, small=False))
    array = [click("dev", "shop"), click(), click(host="unknown"), 5]
    small_rows, rows = (jobs.tagged_rows(messages(spark, array, "["), d) for d in (found, large))
    assert sorted(map(repr, rows.select(*small_rows.columns).collect())) == sorted(map(repr, small_rows.collect()))
    text = plan(jobs.metric_rows(messages(spark, array), large))
    assert "BroadcastHashJoin" not in text and text.count("SortMergeJoin") >= 2
    joined = rows.where("reason IS NULL")
    for line in plan(joined).split("\n"):
        assert not ("Exchange" in line and "raw" in line)


def test_messages_do_not_depend_on_the_splits(spark, sf):
    from tidemark.sources import fixtures

    ev = fixtures.events(spark, sf)
    made = [fixtures.derive_messages(e) for e in (ev.coalesce(1), ev.repartition(4), ev.sort(F.rand(3)).repartition(16))]
    first, *rest = (sorted((r.message_id, r.value) for r in m.collect()) for m in made)
    assert len(first) == -(-ev.count() // 10) and all(r == first for r in rest)


def test_rows_and_quarantine_come_from_one_pass(spark):
    array = [click("dev", "shop"), 5, event(metrics={"x": {"click": value()}})]
    tagged = jobs.tagged_rows(messages(spark, array, "["), dictionaries(spark))
    got = sorted((r.reason or "", r.MID or 0) for r in tagged.collect())
    assert got == [("", 2), ("bad_event", 0), ("bad_json", 0), ("bad_rowkey", 0)]


def test_declared_schema(spark):
    rows = enrich.as_rows(jobs.metric_rows(messages(spark, [click()]), dictionaries(spark)))
    assert [(f.name, f.nullable) for f in rows.schema.fields][:6] == [
        ("MID", False), ("RTIME", False), ("ENV", False), ("APP", True), ("HOST", False),
        ("INSTANCE", True),
    ]
    assert rows.count() == 1


def test_other_json_keys(spark):
    options = jobs.Options(env_key="env", app_key="app")
    renamed = {**click(), "env": "dev", "app": "x"}
    assert rows_of(spark, [renamed], options=options) == [(2, "dev", "x", "h1", "i0")]


def test_local_time_zone(spark):
    options = jobs.Options(zone="America/New_York")
    row = jobs.metric_rows(messages(spark, [click()]), dictionaries(spark), options).first()
    assert row.RTIME == reverse("202401010500")


def test_rows_are_made_without_a_shuffle(spark, sf):
    from tidemark.plans import queries

    rows = jobs.metric_rows(queries.messages(spark, sf), queries.dictionaries(spark, sf))
    text = plan(rows)
    assert "hashpartitioning" not in text and "SortMergeJoin" not in text
    assert text.count("MapInArrow") == 1
    # Parsed once; the other two stand in the branch for messages that do not fit.
    assert text.count("from_json") == 3


def test_filters_on_entries_do_not_parse_twice(spark, sf):
    from tidemark.plans import queries

    good = flatten.good(jobs.entries(queries.messages(spark, sf))).where(F.col("RTIME") > 0)
    assert plan(good).count("from_json") == 3

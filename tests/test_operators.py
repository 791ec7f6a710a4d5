import json
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quadrangle.operators import candidates, duplicates, enrich, ingest, numbering, review, sample, search, selection, upsert
from quadrangle.sources import files, reports, schema
from test_functions import PAGE


def ts(text="2026-01-02 03:04:05"):
    return F.lit(text).cast("timestamp")


CATALOG = "id string, source string, source_id string, name string, normalized_name string, category string, city string, state string, country string, website string, logo_key string, source_year int, is_active int"


def institution(i, source, source_id, name, city, state, website, year, active, category="high_school"):
    return (i, source, source_id, name, name.lower(), category, city, state, "US", website, None, year, active)


@pytest.fixture
def catalog(spark):
    rows = [
        institution("a", "CCD", "1", "Lincoln High", "Salem", "OR", None, 2025, 0),
        institution("b", "PSS", "2", "Lincoln High", "Salem", "OR", "https://l.org", 2024, 1),
        institution("c", "PSS", "3", "Lincoln High", "SALEM", "or", None, 2024, 1),
        institution("d", "CCD", "4", "Lincoln High", None, "OR", None, 2025, 1),
        institution("e", "CCD", "5", "Equal High", "Bend", "OR", None, 2025, 1),
        institution("f", "CCD", "6", "Equal High", "Bend", "OR", None, 2025, 1),
        institution("g", "IPEDS", "7", "Lincoln High", "Salem", "OR", None, 2025, 1, "college"),
    ]
    return spark.createDataFrame(rows, CATALOG)


def write(path, header, rows):
    path.write_text(chr(0xFEFF) + "\r\n".join(",".join(f'"{v}"' for v in r) for r in [header, *rows]) + "\r\n", encoding="utf-8")
    return str(path)


def staged(spark, path, source):
    return ingest.stage(files.read_source(spark, path, source.name), source)


def test_colleges(spark, tmp_path):
    header = ["UNITID ", "INSTNM", "CITY", "STABBR", "WEBADDR", "POSTSEC", "CYACTIVE", "EXTRA"]
    rows = [
        ["1001", "São & Co College", "Boston", "ma", "www.x.edu", "1", "1", "a\nb"], ["1001", "Other", "Boston", "MA", "", "1", "1", ""], ["0", "Zero", "A", "MA", "", "1", "1", ""],
        ["-1", "Sentinel", "A", "MA", "", "1", "1", ""], ["1002", "", "A", "PR", "-2", "2", "3", ""], ["1002", "Valid later", "A", "DC", "http://bad host", "1", "1", ""],
        ["1003", "DC Univ", "-2", "DC", "http://bad host", "1", "1", 'say ""x""'],
    ]
    s = staged(spark, write(tmp_path / "c.csv", header, rows), ingest.IPEDS)
    reasons = [list(r.reasons) for r in s.orderBy("row_no").collect()]
    assert reasons == [
        [], ["duplicate_source_id"], ["invalid_source_id"], ["missing_source_id"], ["missing_name", "not_postsecondary", "inactive", "outside_50_states_plus_dc"], ["duplicate_source_id"], [],
    ]
    records = ingest.accepted(s, ingest.IPEDS, ts())
    first, last = records.orderBy("source_id").collect()
    assert (first.state, first.normalized_name, first.website, first.city) == ("MA", "sao and co college", "https://www.x.edu", "Boston")
    assert (last.city, last.website, last.invalid_website) == (None, None, True)
    stats = ingest.statistics(s, records).first()
    assert (stats.total_rows, stats.selected_rows, stats.duplicate_source_ids, stats.invalid_websites) == (7, 2, 2, 1)
    lines = [r.line for r in ingest.histogram_lines(ingest.reject_histogram(ingest.rejected(s))).collect()]
    assert lines[0] == "duplicate_source_id,2" and lines == sorted(lines)
    log = upsert.import_log(records, ingest.source_url(ingest.IPEDS), "c.csv", ts()).first()
    assert (log.row_count, log.status, log.source_url) == (2, "completed", "https://nces.ed.gov/ipeds/datacenter/data/HD2025.zip")


def test_rows_without_an_id_are_spread(spark):
    row_no = [*range(1, 401)]
    # the names that spread rows get, as ids of others
    named = [str(r.h) for r in spark.createDataFrame([(i,) for i in row_no], "row_no long").select(F.xxhash64("row_no").alias("h")).collect()]
    rows = [(i, " -1") for i in row_no] + [(i - 500, named[i - 1]) for i in row_no[:5]]
    columns = ("INSTNM", "CITY", "STABBR", "WEBADDR", "POSTSEC", "CYACTIVE")
    raw = spark.createDataFrame(rows, "row_no long, UNITID string").select("*", *(F.lit("1").alias(c) for c in columns))
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        got = ingest.stage(raw, ingest.IPEDS).select("source_id", "reasons", F.spark_partition_id().alias("part")).collect()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert len(got) == len(rows) and not any("duplicate_source_id" in r.reasons for r in got)
    parts = [r.part for r in got if r.source_id is None]
    assert len(parts) == 400 and max(parts.count(p) for p in set(parts)) < 200


def test_public_schools(spark, tmp_path):
    header = ["NCESSCH", "SCH_NAME", "LCITY", "LSTATE", "WEBSITE", "SY_STATUS_TEXT", "G_9_OFFERED", "G_10_OFFERED", "G_11_OFFERED", "G_12_OFFERED"]
    statuses = [*ingest.OPEN_STATUSES, "Closed", "open"]
    rows = [[str(i + 1), "S", "C", "OR", "", s, "No", "No", "No", "Yes"] for i, s in enumerate(statuses)]
    rows += [["20", "S", "C", "DC", "", "Open", "No", "No", "No", "Yes"], ["21", "S", "C", "OR", "", "Open", "No", "No", "Not applicable", "No"]]
    got = staged(spark, write(tmp_path / "p.csv", header, rows), ingest.CCD).orderBy("row_no").collect()
    assert [len(r.reasons) for r in got] == [0] * 5 + [1] * 4
    assert [r.reasons[0] for r in got[5:]] == ["inactive_or_noncurrent_status"] * 2 + ["outside_50_states", "no_grade_9_to_12_offered"]


def test_private_schools(spark, tmp_path):
    header = ["PPIN", "PINST", "PCITY", "PSTANSI", "PL_CIT", "P265", "P275", "P285", "P295"]
    rows = [["A0100001", "S", "M", "1", "P", "1", "", "", ""], ["A2", "S", "M", "06", "", "", "1", "", ""], ["A3", "S", "", "001", "", "", "", "", "1"], ["A4", "S", "", "11", "", "1", "", "", ""], ["A5", "S", "-1", "02", "", "1", "", "", ""]]
    s = staged(spark, write(tmp_path / "q.csv", header, rows), ingest.PSS)
    records = ingest.accepted(s, ingest.PSS, ts())
    assert [(r.source_id, r.state, r.city, r.mailing_fallback, r.website) for r in records.orderBy("source_id").collect()] == [
        ("A0100001", "AL", "P", False, None), ("A2", "CA", "M", True, None), ("A5", "AK", None, False, None),
    ]


def test_input_errors(spark, tmp_path):
    with pytest.raises(files.InputError, match="INSTNM, CITY"):
        files.read_source(spark, write(tmp_path / "x.csv", ["UNITID", "STABBR", "WEBADDR", "POSTSEC", "CYACTIVE"], [["1"] * 5]), "IPEDS")
    (tmp_path / "short.csv").write_text("a,b\n1,2\n3\n")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        files.read_csv(spark, str(tmp_path / "short.csv")).collect()
    (tmp_path / "none").mkdir()
    with pytest.raises(files.InputError):
        files.read_enriched(spark, str(tmp_path / "none"))


def test_upsert_keeps_and_overwrites(spark, catalog):
    old = F.lit("2025-01-01").cast("timestamp")
    target = catalog.withColumn("logo_key", F.lit("k")).withColumns({"created_at": old, "imported_at": old, "updated_at": old})
    incoming = catalog.where("id in ('b', 'e')").withColumns({"id": F.concat(F.lit("new-"), "id"), "website": F.lit(None).cast("string"), "source_id": F.when(F.col("id") == "e", "99").otherwise(F.col("source_id")), "imported_at": ts()})
    out = {r.source_id: r for r in upsert.upsert(target, incoming, ts()).collect()}
    assert len(out) == 8 and out["2"].id == "b" and out["2"].website is None and out["2"].logo_key == "k"
    assert out["2"].created_at.year == 2025 and out["2"].updated_at.year == 2026 and out["1"].updated_at.year == 2025
    assert out["99"].id == "new-e" and out["99"].created_at.year == 2026
    kept = {r.source_id: r for r in upsert.upsert(target, incoming, ts(), preserve_website=True).collect()}
    assert kept["2"].website == "https://l.org"
    assert tuple(upsert.preview(target, incoming).first()) == (1, 1)
    again = upsert.upsert(upsert.upsert(target, incoming, ts()), incoming, ts())
    assert sorted(map(str, again.collect())) == sorted(map(str, upsert.upsert(target, incoming, ts()).collect()))


def test_publish(spark, catalog, tmp_path):
    upsert.publish(catalog, str(tmp_path / "t"))
    upsert.publish(catalog.where("id <> 'a'"), str(tmp_path / "t"))
    assert upsert.current(spark, str(tmp_path / "t")).count() == 6


def test_audits(catalog):
    exact = {r.group_key: (r.size, r.candidate_type) for r in duplicates.exact_location(catalog).collect()}
    assert exact == {"high_school | OR | lincoln high | Salem": (2, "cross_source"), "high_school | OR | equal high | Bend": (2, "same_source_location")}
    by_name = {r.group_key: r.size for r in duplicates.same_name_state(catalog).collect()}
    assert by_name == {"high_school | OR | lincoln high": 3, "high_school | OR | equal high": 2}
    assert duplicates.source_key_collisions(catalog).count() == 0


def test_merge(catalog):
    plans = duplicates.plan(catalog)
    lincoln = plans.where("normalized_name = 'lincoln high'").first()
    assert lincoln.group_key == "high_school | OR | lincoln high | salem" and lincoln.size == 3
    assert (lincoln.canonical_id, lincoln.source_year, lincoln.is_active, lincoln.website) == ("b", 2025, 1, "https://l.org")
    assert lincoln.conflicts == {"city": ["SALEM", "Salem"], "state": ["OR", "or"], "source_year": ["2024", "2025"]}
    assert plans.where("normalized_name = 'equal high'").first().canonical_id == "e"
    totals = duplicates.plan_totals(catalog, plans).first()
    assert (totals.groups, totals.rows, totals.deletions, totals.conflict_groups, totals.ungroupable) == (2, 5, 3, 1, 1)
    merged = upsert.apply_merges(catalog, duplicates.merged_rows(plans), duplicates.superseded(catalog))
    assert sorted(r.id for r in merged.collect()) == ["b", "d", "e", "g"]
    assert duplicates.plan(merged).count() == 0  # nothing is left to merge


def test_review(spark, catalog):
    found = review.named_groups(duplicates.same_name_state(catalog))
    keys = [F.col("category"), F.col("state"), F.col("normalized_name")]
    members = duplicates.with_members(catalog, found, keys)
    ccd = spark.createDataFrame([("1", "Old", "Open", 1), ("1", "Lincoln HS", "Open", 2)], "NCESSCH string, SCH_NAME string, SY_STATUS_TEXT string, row_no long")
    ccd = ccd.withColumns({c: F.lit("-1") for c in ("LCITY", "LSTATE", "WEBSITE")}).withColumns({"LSTREET1": F.lit("1 Main"), "LSTREET3": F.lit("B")})
    pss = spark.createDataFrame([("2", "L", "", "Salem", 1)], "PPIN string, PINST string, PL_CIT string, PCITY string, row_no long")
    table = {r.dbId: r for r in review.review_table(members, review.contexts({"CCD": ccd, "PSS": pss})).collect()}
    assert len(table) == 5 and {r.groupId for r in table.values()} == {"DUP-0001", "DUP-0002"} and table["a"].groupId == "DUP-0001"
    assert (table["a"].rawName, table["a"].sourceAddress, table["a"].sourceMatch, table["a"].website) == ("Lincoln HS", "1 Main, B", "matched_raw_row", None)
    assert table["b"].sourceCity == "Salem" and table["b"].reviewNotes.startswith("Physical city")
    assert table["e"].sourceMatch == "missing_raw_row" and table["e"].reviewNotes == "Raw source row was not found."


def enriched(tmp_path, name, rows):
    folder = tmp_path / name
    folder.mkdir()
    write(folder / "a.CSV", list(schema.ENRICHMENT), rows)
    return str(folder)


def reference(i, site, name="Lincoln High", city="Salem", state="OR"):
    return [i, name, "high_school", city, state, "US", site]


def test_research_comes_back(spark, catalog, tmp_path):
    rows = [reference("a", "https://a.org/#top"), reference("b", "https://l.org"), reference("d", "", city=""), reference("e", "ftp://x.org", "Equal High", "Bend"), ["", " ", "", "", "", "", ""], reference("f", "https://u:p@x.org", "Equal High", "Bend")]
    records = files.read_enriched(spark, enriched(tmp_path, "in", rows))
    assert [r.row_number for r in records.orderBy("row_number").collect()] == [2, 3, 4, 5, 7]
    local = catalog.withColumn("website", F.when(F.col("id") == "b", "https://l.org/").otherwise(F.col("website")))
    outcomes, fine = enrich.reconcile(records, local)
    assert fine and {r.id: r.outcome for r in outcomes.collect()} == {"a": "would_update_local", "b": "already_current_local", "d": "unresolved", "e": "invalid_website", "f": "invalid_website"}
    updated = upsert.fill_blank(local.withColumn("updated_at", F.lit(None).cast("timestamp")), enrich.updates(outcomes), ["id"], "website", ts())
    assert {r.id for r in updated.where("updated_at is not null").collect()} == {"a"} and updated.where("id = 'a'").first().website == "https://a.org/"
    assert enrich.applied(outcomes).where("outcome = 'updated_local'").count() == 1
    other = files.read_enriched(spark, enriched(tmp_path, "other", [reference("b", "https://other.org")]))
    assert enrich.reconcile(other, local)[0].first().outcome == "local_website_conflict"


def test_a_folder_of_csv_files_is_one_scan(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for i in range(2000):
        write(folder / f"b{i:04d}.csv", list(schema.ENRICHMENT), [reference(f"i{i}-{j}", "" if j else "https://x.org", name='two ""quoted"",\nlines') for j in range(i % 3)])
    (folder / "notes.txt").write_text("no csv")
    spark.sparkContext.setJobGroup("folder", "one folder")
    rows = files.read_enriched(spark, str(folder))
    tracker = spark.sparkContext.statusTracker()
    # a scan of every file would be a job of its own; all files are read by one stage
    assert len(tracker.getJobIdsForGroup("folder")) < 12
    got = {(r.file_name, r.row_number, r.id) for r in rows.collect()}
    assert got == {(f"b{i:04d}.csv", j + 2, f"i{i}-{j}") for i in range(2000) for j in range(i % 3)}
    assert {r.name for r in rows.select("name").distinct().collect()} == {'two "quoted",\nlines'}
    write(folder / "b9998.csv", ["id", *schema.ENRICHMENT[1:-1], "site"], [])
    with pytest.raises(files.InputError, match="b9998.csv: the header must be id,"):
        files.read_enriched(spark, str(folder))
    (folder / "b9998.csv").write_text("")
    with pytest.raises(files.InputError, match="b9998.csv"):
        files.read_enriched(spark, str(folder))
    (folder / "b9998.csv").write_text(chr(0xFEFF) + ",".join(schema.ENRICHMENT) + "\r\na,b\r\n")
    with pytest.raises(files.InputError, match="b9998.csv: row 2 has"):
        files.read_enriched(spark, str(folder))
    with pytest.raises(files.InputError, match="no CSV"):
        files.read_enriched(spark, str(tmp_path))


def test_the_gate_reads_the_batch_once(spark, catalog, tmp_path):
    """The checks run in the job that writes their result; what is done with it afterwards reads that table."""
    rows = [reference("a", "https://a.org"), reference("b", "https://b.org")]
    outcomes, fine = enrich.reconcile(files.read_enriched(spark, enriched(tmp_path, "in", rows)), catalog)
    assert fine and {r.outcome for r in outcomes.collect()} == {"would_update_local", "local_website_conflict"}
    plan = outcomes._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan and "Window" not in plan and "Python" not in plan


def test_one_structural_problem_blocks_all(spark, catalog, tmp_path):
    rows = [reference("a", "https://a.org"), reference("zz", "https://z.org"), reference("g", "https://g.org", "Edited"), reference("e", "", "Equal High", "Bend"), reference("e", "", "Equal High", "Bend"), reference("", "https://q.org")]
    outcomes, fine = enrich.reconcile(files.read_enriched(spark, enriched(tmp_path, "in", rows)), catalog)
    assert not fine
    assert [r.outcome for r in outcomes.orderBy("row_number").collect()] == ["pending", "unknown_local_id", "modified_reference_fields", "duplicate_or_blank_id", "duplicate_or_blank_id", "unknown_local_id"]


def test_export(spark, catalog, tmp_path):
    rows = enrich.missing_websites(catalog, 4)
    names = reports.write_batches(rows, str(tmp_path), list(schema.ENRICHMENT))
    assert names == ["website-research-batch-0001.csv", "website-research-batch-0002.csv"]
    text = (tmp_path / names[0]).read_bytes().decode("utf-8")
    assert text.startswith(chr(0xFEFF) + "id,name,category") and text.count("\r\n") == 5
    reports.write_batches(rows.limit(1), str(tmp_path), ["id"])
    assert len(list(tmp_path.glob("*.csv"))) == 1


def test_reports(spark, tmp_path):
    rows = spark.createDataFrame([('a"b', None, "x,y\n" + chr(0)), ("z", "1", "<&'")], "p string, q string, r string").repartition(3).sortWithinPartitions("p")
    path = tmp_path / "r.csv"
    path.write_text("old")
    for nul, shown in ((" ", " "), (None, chr(0))):
        assert reports.write_report_csv(rows.orderBy("p"), str(path), nul) == 2
        assert path.read_bytes().decode() == chr(0xFEFF) + f'p,q,r\r\n"a""b",,"x,y\n{shown}"\r\nz,1,<&\'\r\n'
    assert reports.write_report_csv(rows.limit(0), str(path)) == 0 and path.read_bytes().decode() == chr(0xFEFF) + "p,q,r\r\n"
    reports.write_review_page(rows.orderBy("p"), str(tmp_path / "r.html"), "t & u")
    page = (tmp_path / "r.html").read_text()
    assert "<title>t &amp; u</title>" in page and "<tr><td>z</td><td>1</td><td>&lt;&amp;&#x27;</td></tr>" in page and page.index("a&quot;b") < page.index("<td>z")
    many = spark.range(3000, numPartitions=7).select(F.col("id"), F.concat(F.lit('v"'), "id").alias("v"))
    assert reports.write_report_csv(many, str(path)) == 3000
    lines = path.read_text(encoding="utf-8-sig").splitlines()
    assert lines[1:] == [f'{i},"v""{i}"' for i in range(3000)]
    table = str(tmp_path / "table")
    reports.append_csv_table(many, table)
    reports.append_csv_table(many.limit(10), table)
    assert spark.read.csv(table, header=True, escape='"').where('v like \'v"%\'').count() == 3010
    assert not [p for p in tmp_path.iterdir() if not p.name.startswith(".") and (".csv." in p.name or ".html." in p.name)]


def test_nested_report(spark, catalog, tmp_path):
    """The report that an audit writes is one JSON document, and the review reads its groups back."""
    rows = spark.createDataFrame([(f"k{i % 5}" if i < 60 else f"u{i}", f"id{i}", None if i % 3 else f'n"{i}') for i in range(70)] + [("k1", "id1", None)] * 2, "group_key string, id string, name string")
    groups = rows.groupBy("group_key").agg(F.count("*").alias("size")).where("size > 1").withColumn("candidateType", F.lit("same_name_state"))
    path, none = str(tmp_path / "audit.json"), groups.limit(0)
    members = rows.join(groups.select("group_key"), "group_key", "left_semi")
    reports.write_nested_json({"mode": "read-only", "totals": {"groups": 5}}, {"empty": (none, members.limit(0)), "sameNameStateCandidates": (groups, members)}, path)
    document = json.loads((tmp_path / "audit.json").read_text())
    assert list(document) == ["mode", "totals", "empty", "sameNameStateCandidates"] and document["totals"] == {"groups": 5} and document["empty"] == []
    found = document["sameNameStateCandidates"]
    assert [(g["key"], g["size"]) for g in found] == [("k1", 14), ("k0", 12), ("k2", 12), ("k3", 12), ("k4", 12)]
    assert sorted(str((g["key"], m["id"], m["name"])) for g in found for m in g["rows"]) == sorted(str((r.group_key, r.id, r.name)) for r in members.collect())
    assert all(len(g["rows"]) == g["size"] for g in found)
    back = files.read_report(spark, path, "sameNameStateCandidates")
    assert {(r.key, r.candidateType, len(r.rows)) for r in back.collect()} == {(g["key"], "same_name_state", g["size"]) for g in found}
    (tmp_path / "other.json").write_text(json.dumps({"exactLocationCandidates": [{"key": "k", "rows": []}]}, indent=2))
    assert files.read_report(spark, str(tmp_path / "other.json")).first().key == "k"


def test_search(spark, catalog):
    found = search.search(catalog, "lincon high", 3)
    assert [(r.id, r.tier) for r in found.collect()] == [("a", 3), ("b", 3), ("c", 3)]
    aliases = spark.createDataFrame([("institution", "g", "LH", "lh")], "entity_type string, entity_id string, alias string, normalized_alias string")
    assert [r.id for r in search.search(catalog, "LH", aliases=aliases).collect()] == ["g"]
    for bad in ({"query": "b"}, {"query": "boston", "limit": 0}, {"query": "boston", "limit": 26}, {"query": "boston", "limit": "x"}, {"query": "boston", "category": "library"}):
        with pytest.raises(search.SearchError) as e:
            search.search(catalog, **bad)
        assert (e.value.code, e.value.status) == ("INVALID_QUERY", 400)
    assert search.lookup_one(catalog, "b", "https://s")["logo_url"] is None
    with pytest.raises(search.SearchError):
        search.lookup_one(catalog, "nobody")


def test_samples(spark, catalog):
    chosen = sample.balanced(catalog, 4, "s")
    assert chosen.where("category = 'college'").count() == 1 and chosen.count() == 4
    assert {r.id for r in chosen.collect()} == {r.id for r in sample.balanced(catalog.repartition(3), 4, "s").collect()}
    manifest = spark.createDataFrame([("a", "error"), ("a", "candidate"), ("b", "error")], "institution_id string, status string")
    assert {r[0] for r in sample.processed(manifest).collect()} == {"a", "b"} and {r[0] for r in sample.processed(manifest, True).collect()} == {"a"}
    assert sample.unprocessed(catalog, sample.processed(manifest)).count() == 5


def test_numbering(spark):
    rows = numbering.numbered(spark.range(1000).repartition(7), [F.desc("id")], "n").collect()
    assert sorted((r.n, r.id) for r in rows) == [(i + 1, 999 - i) for i in range(1000)]


def test_candidates(spark):
    pages = spark.createDataFrame([("i", "Lincoln High School", "https://x.edu/", PAGE)], "id string, name string, page_url string, html string")
    best = candidates.inventory(candidates.best_per_asset(candidates.scored(candidates.page_mentions(pages))))
    rows = {r.key: r for r in best.collect()}
    assert "https://x.edu/x/logo.png" in rows and sum("x/logo.png" in k for k in rows) == 1  # renditions are one asset
    assert not any(bad in k for k in rows for bad in ("hero", "v.mp4", "sprite", "pic.jpg"))
    assert any(k.startswith("inline-svg:") for k in rows) and rows["https://x.edu/logo.png"].qualification == "strong"
    retrieval = selection.top_by_score(best)
    assert retrieval.where("source = 'document-icon'").first().status == "deferred_favicon" and retrieval.orderBy("final_rank", ascending=True).where("final_rank = 1").count() == 1
    empty = candidates.page_mentions(spark.createDataFrame([("j", "N", "https://y.edu/", "")], pages.schema))
    only = selection.top_by_score(candidates.inventory(candidates.best_per_asset(candidates.scored(empty)))).collect()
    assert [(r.key, r.status, r.final_rank) for r in only] == [("https://y.edu/favicon.ico", "selected_as_favicon_fallback", 1)]
    by_text = selection.ranked_by_text(best, selection.ScoreRanker(2), winners=2).where("final_rank is not null")
    assert by_text.count() == 2
    images = best.select("key", F.lit(64).alias("width"), F.lit(64).alias("height"), F.col("key").cast("binary").alias("preview"))
    shown = selection.with_images(retrieval, images)
    chosen = selection.select_by_score(shown).where("auto_selected").collect()
    assert len(chosen) == 1 and chosen[0].candidate_rank == 1
    picks = spark.createDataFrame([("i", 1, 0.9)], "id string, chosen int, confidence double")
    views = shown.select("id", "candidate_rank", F.lit("logo").alias("kind"), F.lit(True).alias("eligible"))
    assert selection.select_by_assessment(shown, picks, views).where("auto_selected").count() == 1
    assert selection.invalid_selections(shown, picks, views).count() == 0
    assert selection.invalid_selections(shown, picks.withColumn("chosen", F.lit(99)), views).count() == 1


def test_crawl(spark):
    schools = spark.createDataFrame([("i", "S", "x.edu")], "id string, name string, website string")
    pages = spark.createDataFrame(
        [("https://x.edu/", '<a href="/about">a</a><a href="/media">logo media</a><a href="https://y.org/about">z</a>'), ("https://x.edu/media", '<a href="/contact">c</a>'), ("https://x.edu/about", ""), ("https://x.edu/contact", "")],
        "url string, html string",
    )
    visits = candidates.crawl(schools, pages, 3).orderBy("visit").collect()
    assert [r.page_url for r in visits] == ["https://x.edu/", "https://x.edu/media", "https://x.edu/about"]


def test_crawl_meets_shared_and_repeated_pages(spark):
    schools = spark.createDataFrame([(i, "S", "x.edu") for i in "abc"] + [("d", "T", "none.edu"), ("e", "U", None)], "id string, name string, website string")
    home = '<a href="/about">about</a><a href="/media">brand logo media</a><a href="/">about us</a><a href="https://y.org/about">z</a>' + "".join(f'<a href="/contact{i}">c</a>' for i in range(50))
    pages = spark.createDataFrame([("https://x.edu/", home), ("https://x.edu/", home), ("https://x.edu/media", "m"), ("https://x.edu/about", "b"), ("https://x.edu/about", "a"), ("https://x.edu/contact0", None)], "url string, html string")
    got = candidates.crawl(schools, pages, 4)
    assert sorted(got.columns) == ["html", "id", "name", "page_url", "root_url", "visit"]
    rows = sorted((r.id, r.visit, r.page_url.removeprefix("https://x.edu"), r.html) for r in got.collect())
    assert rows == [(i, *v) for i in "abc" for v in ((0, "/", home), (1, "/media", "m"), (2, "/about", "a"), (3, "/contact0", None))]


def test_parts_of_a_crawl_grow_with_it(spark, monkeypatch):
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before, during, write = [spark.conf.get(k) for k in names], [], candidates.written

    def noted(rows):
        during.append([spark.conf.get(k) for k in names])
        return write(rows)

    monkeypatch.setattr(candidates, "written", noted)
    monkeypatch.setattr(candidates, "CRAWL_ROWS", 10, raising=False)
    schools = spark.range(95).selectExpr("cast(id as string) as id", "'S' as name", "concat('https://s', id, '.edu/') as website")
    pages = schools.selectExpr("website as url", "'<a href=\"/about\">about</a>' as html").unionByName(schools.selectExpr("concat(website, 'about') as url", "'' as html"))
    got = candidates.crawl(schools, pages, 2)
    assert got.count() == 190 and got.select("id", "visit").distinct().count() == 190
    assert during and all(x == ["10", str(1 << 20)] for x in during)
    assert [spark.conf.get(k) for k in names] == before


def test_a_page_with_very_many_mentions(spark):
    """Mentions leave the task in batches; the worker holds the page and one batch."""

    def parse(batches):
        import resource

        from quadrangle.functions.html_mentions import streamed

        for b in batches:
            for html in b["html"]:
                n = sum(1 for _ in streamed(html * 200_000, "https://x.edu/"))
                yield b.assign(n=n, mb=resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)[["n", "mb"]]

    image = '<p><img src="/a.png" alt="a picture of the town"></p>'
    row = spark.createDataFrame([(image,)], "html string").coalesce(1).mapInPandas(parse, "n long, mb long").first()
    assert row.n == 200_001 and row.mb < 400
    pages = spark.createDataFrame([("i", "S", "https://x.edu/", image * 30_000), ("j", None, None, None)], "id string, name string, page_url string, html string")
    found = candidates.page_mentions(pages)
    assert found.where("id = 'i'").count() == 30_001 and found.where("id = 'i'").select("ord").distinct().count() == 30_001
    assert found.where("id = 'i'").select("id", "page_url", "name").distinct().count() == 1


def counting(folder):
    """Loads a model that counts its loads and batches in files, and ranks by key, last first."""

    def name(kind):
        return Path(folder, f"{kind}-{uuid.uuid4().hex}")

    class Counting:  # in a function, so that it travels to the workers
        def rank(self, shown):
            raise AssertionError("lists come together")

        def rank_many(self, lists):
            name(f"batch-{len(lists)}").touch()
            return [[x["index"] for x in sorted(shown, key=lambda x: x["key"], reverse=True)][:12] + [99, 1, 1] for shown in lists]

    def load():
        name("load").touch()
        return Counting()

    return load


def tournament(rows, rank):
    """The two levels for one institution, one after the other."""
    rankable = [r for r in rows if r[2] != "favicon-fallback"]
    short = [r for lo in range(0, len(rankable), 36) for r in rank(rankable[lo : lo + 36])]
    final = short if len(short) <= 12 else rank(short)
    return {r[3]: i + 1 for i, r in enumerate(final)}


def test_a_model_ranks_many_institutions_at_a_time(spark, tmp_path):
    rows = [(f"i{i}", j + 1, "favicon-fallback" if (i + j) % 9 == 0 else "image-element", f"k{(j * 7919) % 1000:03d}-{i}", (i * j) % 50) for i in range(40) for j in range(i * 3)]
    inventory = spark.createDataFrame(rows, "id string, inventory_index int, source string, key string, initial_score int").coalesce(2)
    folder = str(tmp_path)
    out = selection.ranked_by_text(inventory, counting(folder), model_batch=16).collect()

    def rank(some):
        best = sorted(some, key=lambda r: r[3], reverse=True)[:12]
        return best + [r for r in some[:1] if r not in best]  # 99 is no candidate, and each counts once

    final = {(i, k): n for i in {r[0] for r in rows} for k, n in tournament([r for r in rows if r[0] == i], rank).items()}
    assert {(r.id, r.key): r.final_rank for r in out if r.final_rank and r.source == "image-element"} == final
    loads, sizes = len(list(tmp_path.glob("load-*"))), [int(p.name.split("-")[1]) for p in tmp_path.glob("batch-*")]
    lists = sum(-(-len([r for r in rows if r[0] == f"i{i}" and r[2] == "image-element"]) // 36) for i in range(40))
    assert sum(sizes) >= lists and max(sizes) == 16 and len(sizes) < sum(sizes) / 4 and loads <= 16

    def by_score(some):
        return sorted(some, key=lambda r: (-r[4], r[3]))[:12]

    out = selection.ranked_by_text(inventory, selection.ScoreRanker()).collect()
    final = {(i, k): n for i in {r[0] for r in rows} for k, n in tournament([r for r in rows if r[0] == i], by_score).items()}
    assert {(r.id, r.key): r.final_rank for r in out if r.final_rank and r.source == "image-element"} == final
    assert len(out) == len(rows)


def test_web_manifest(spark):
    rows = spark.createDataFrame([("i", "S", "https://x.edu/m.json", '{"icons":[{"src":"logo.png","sizes":"64x64"},{"sizes":"1"}]}')], "id string, name string, page_url string, manifest string")
    (only,) = candidates.scored(candidates.manifest_mentions(rows)).collect()
    assert only.key == "https://x.edu/logo.png" and only.initial_score >= 58


def test_constraints(spark, catalog):
    rows = catalog.withColumns({c: ts() for c in ("created_at", "imported_at", "updated_at")})
    assert schema.violations(rows).count() == 0
    bad = rows.withColumns({"category": F.lit("library"), "country": F.lit(None).cast("string")}).limit(1)
    assert list(schema.violations(bad).first().violations) == ["country is missing", "category"]


def test_manifest(spark, tmp_path):
    assert files.read_manifest(spark, str(tmp_path / "none.csv"), str(tmp_path / "old.csv")).count() == 0
    old = write(tmp_path / "old.csv", ["institution_id", "category", "status"], [["a", "library", "error"], ["b", "college", "x"]])
    rows = files.read_manifest(spark, str(tmp_path / "none.csv"), old)
    assert tuple(rows.columns) == schema.MANIFEST and [r.category for r in rows.orderBy("institution_id").collect()] == ["high_school", "college"]
    bad = write(tmp_path / "bad.csv", ["institution_id", "category"], [["", "college"]])
    assert files.read_manifest(spark, str(tmp_path / "none.csv"), bad).count() == 0
    reports.append_csv(spark.createDataFrame([("c", "college", "y,z")], "i string, c string, s string"), old)
    assert [(r.institution_id, r.status) for r in files.read_manifest(spark, old).orderBy("institution_id").collect()] == [("a", "error"), ("b", "x"), ("c", "y,z")]

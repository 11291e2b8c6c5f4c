import duckdb
import numpy as np
import pytest
from cases import DATA, documents

from weirline.llm import licenses, queries

MIT, APACHE = licenses.NOTICES["mit"], licenses.NOTICES["apache-2.0-header"]


def found(spark, texts, settings=None):
    rows = licenses.scan(documents(spark, texts), settings).collect()
    return sorted((r.doc_id, r.license, r.containment) for r in rows)


def test_awkward_texts(spark):
    changed = APACHE.replace("except", "save")  # one word: 5 of 24 shingles change
    longer = APACHE + " one more word"
    texts = [None, "", "MIT", f"x {MIT} y", MIT.upper(), "released under\n the mit -- license", longer]
    texts += [MIT, f"{'pad ' * 100_000}{MIT}", "under the MIT License released", changed]
    rows = found(spark, texts)
    hit = {(i, name) for i, name, _ in rows}
    assert {(i, "mit") for i in (3, 4, 5, 7, 8)} | {(6, "apache-2.0-header"), (6, "apache-2.0")} <= hit
    assert not {i for i, _ in hit} & {0, 1, 2, 9}
    assert (10, "apache-2.0") in hit
    share = licenses.Settings(containment=0.7)
    assert (10, "apache-2.0-header") in {(i, n) for i, n, _ in found(spark, texts, share)}
    assert found(spark, []) == []


def test_repeated_rows_and_templates(spark):
    docs = documents(spark, [MIT])
    assert licenses.scan(docs.union(docs)).count() == 2
    with pytest.raises(ValueError):
        licenses.scan(docs, licenses.Settings(templates={"short": "too few words"})).collect()


def test_bands_bound_the_chance_of_a_miss():
    for size in (1, 2, 4, 8, 16, 32, 64):
        n = licenses.bands(size, 0.8, 1e-4)
        for shingles in range(size // 2 + 1, size + 1):
            assert (1 - licenses.least_jaccard(shingles, size, 0.8)) ** n <= 1e-4


def test_plan_is_native(spark):
    plan = licenses.scan(documents(spark, [MIT]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_whole_table_against_sql(spark):
    sf = str(DATA).replace("0.001", "0.01")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    sql = con.execute(queries.ORACLE_SQL["op3_license_scan"]).fetchdf()
    ours = queries.op3_license_scan(spark, sf).toPandas()
    columns = ["doc_id", "license", "n_windows", "containment"]
    sort = lambda df: df[columns].sort_values(columns).to_numpy().tolist()
    assert len(ours) > 10 and sort(ours) == sort(sql)
    assert np.all(ours["containment"] >= 0.8)

"""Queries with DuckDB SQL, on the small driver tables and on awkward rows."""

from collections import Counter

import duckdb
import pytest
from ledgerline.llm import oracle, queries

TABLES = ("documents", "benchmark", "pages", "conversations")


def same(spark, sf_dir, key, names=TABLES):
    con = duckdb.connect()
    for t in names:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}{'' if sf_dir.count('testdata') else '/*.parquet'}')")
    df = queries.QUERIES[key](spark, sf_dir)
    found = con.execute(oracle.oracle_sql()[key])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    want = Counter(tuple(r) for r in found.fetchall())
    assert Counter(tuple(r) for r in df.select(*columns).collect()) == want


@pytest.mark.parametrize("key", sorted(oracle.oracle_sql()))
def test_driver_tables(spark, sf_dir, key):
    same(spark, sf_dir, key)


ROWS = [(1, None, "a"), (None, "", "a"), (3, "Home | News | About | Help", None), (3, "Home | News | About | Help", None),
        (4, "one two three four five six seven eight nine ten " * 4, "b"), (5, "x x x x y y y z\nAll rights reserved.\n\n  \nx x x x y y y z", "b"),
        (6, "A\x0bb\rc\x1cd é Ü, THE the The\nsecond line, all right.", "c"), (7, "word " * 3000, "b"), (8, "cat? dog! ### $$$", "d"),
        (9, "Startseite Über uns Kontakt\nAccueil À propos Contact.\nInicio, Sobre nosotros, Contacto.\nStartseite Accueil Inicio Ayuda.\nDe la du.", "d"),
        (10, "TOUS DROITS RÉSERVÉS sur ce site.\nhalle Rechte vorbehalten sind hier.\n(Alle Rechte vorbehalten) 2020 GmbH.\n" + "Ein Wort gibt das andere Wort. " * 8, "e"),
        (11, "Lisez nos conditions d’utilisation.\nSÍGUENOS en la red.\nsiguenos en la red.\n" + "una palabra lleva a la otra " * 5, "e")]


@pytest.mark.parametrize("key", ["op1_temperature_mixing", "op3_fm_decontamination", "op8_line_quality"])
def test_awkward_documents(spark, make_docs, save, key):
    items = spark.createDataFrame([(1, "the THE the"), (2, "word " * 13), (3, None), (None, "cat dog"), (20, "second line all right")],
                                  "item_id long, text string")
    same(spark, save(documents=make_docs(ROWS), benchmark=items), key, ("documents", "benchmark"))


def test_every_query_is_registered():
    import __spark_entry__ as entry
    assert [sum(k.startswith(f"op{n}_") for k in entry.queries()) for n in range(1, 11)] == [1] * 10
    assert "pipeline" in entry.queries() and set(oracle.oracle_sql()) <= set(entry.oracle_sql())

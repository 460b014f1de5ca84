import brute
from ledgerline.llm import line_quality, queries
from pyspark.sql import functions as F

NAMES = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
PROSE = "The river ran past the old mill and the people of the town came down to see it every spring."


def base(spark, sf_dir):
    return sorted((tuple(r[n] for n in NAMES) for r in queries.op8_line_quality(spark, sf_dir).collect()), key=repr)


def test_query_against_plain_figures(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert base(spark, sf_dir) == sorted(((d, *brute.quality_base(t)) for d, t in docs), key=repr)


def test_edges(spark, make_docs, save):
    run = "a b c d e f g h"
    rows = [(1, None), (2, ""), (3, " \n\t\x0b "), (None, PROSE), (5, f"{run} {run}"), (6, f"{run} x {run} y {run}"),
            (7, "z " * 40), (8, "x\n\nx\n x\nx"), (9, "#*$%&|<> é#  "), (9, "#*$%&|<> é#  "),
            (10, " ".join(f"w{i % 5000}" for i in range(50_000))), (11, "a\rb\x1cc d")]
    sf_dir = save(documents=make_docs([(i, t, "s", True) for i, t in rows], ", kept boolean"))
    assert base(spark, sf_dir) == sorted(((d, *brute.quality_base(t)) for d, t in rows), key=repr)


def test_empty(spark, make_docs):
    assert line_quality.judge(make_docs([])).count() == 0


def fails(spark, lines):
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    return [r[0] for r in df.select(line_quality.line_fails(F.col("line"))).collect()]


def test_rules(spark):
    bad = ["Home | About | Contact | Login", "HOME", "a### b*** c$$$ d%%%", "WOW!! SO!! LOUD!! HERE!!", "All rights reserved.",
           "Please click here to accept cookies and continue.", "two words", "on on on on by by by.", "News > Sports > Tennis"]
    good = [PROSE, "", "   ", "Yes.", "Costs fell by 5% (see the report), said A. Smith & Sons.", "He asked: why?", "It is very, very, very cold out there today.", "a or b | c is a pipe in the text of this line"]
    assert fails(spark, bad) == [True] * len(bad)
    assert fails(spark, good) == [False] * len(good)


def test_rules_of_other_languages(spark):
    """Written by hand with the lists in view: what the rules do, not how well they do on unseen pages."""
    bad = ["Alle Rechte vorbehalten.", "ALLE RECHTE VORBEHALTEN, Verlag Muster 2019.", "Tous droits réservés sur ce site.",
           "TOUS DROITS RÉSERVÉS (Éditions du Lac).", "Startseite Über uns Kontakt Impressum", "Accueil Plan du site Contact Mentions légales",
           "Inicio Sobre nosotros Contacto Mapa web Ayuda", "Diese Seite verwendet Cookies, um Ihren Besuch angenehmer zu machen.",
           "Ce site utilise des cookies pour mesurer son audience.", "Esta web utiliza cookies propias y de terceros.",
           "Lesen Sie bitte unsere Datenschutzerklärung.", "Consulte nuestra política de privacidad.", "Para continuar, haga clic aquí.",
           "Todos los derechos reservados.", "Lisez nos conditions d’utilisation."]
    good = ["Der Kontakt zu den Nachbarn brach nach dem langen Winter ab.", "Die Suche nach dem Impressum dauerte einen Tag.",
            "Die Rechte der Bürger sind in der Verfassung festgelegt.", "Le contact avec la ville fut perdu pendant la tempête.",
            "Il rechercha le plan de la vieille ville pendant deux jours.", "Les droits des enfants sont réservés à la lecture du juge.",
            "El mapa de la isla estaba sobre la mesa de la cocina.", "Volver al sitio de siempre fue para ella una gran ayuda.",
            "La política de la ciudad cambió después de las elecciones.", "Er wollte mehr erfahren und fragte die alte Frau.",
            "De la.", "Nach oben.", "Sobre nosotros.", "Über uns der Himmel, unter uns das Meer."]
    assert fails(spark, bad) == [True] * len(bad)
    assert fails(spark, good) == [False] * len(good)


OTHER = "Nobody had thought to bring a lamp, so we waited by the gate until the moon rose over the hill."


def test_very_long_lines(spark):
    """Whatever repeats, a line of any length is judged."""
    lines = [f"{w} " * 60_000 for w in ("home", "x", "| a", "### b", "(", "About us,", "!!")] + ["home" * 60_000, "|" * 200_000]
    assert fails(spark, lines) == [True] * 9


def test_lines_go_and_documents_stay(make_docs):
    text = f"Home | News | About | Help\n{PROSE}\n\n{OTHER} Twice."
    rows = [(1, text, "s", 5), (2, PROSE + "\n" + " | ".join(f"x{i}" for i in range(300)), "s", 5),
            (3, f"{PROSE} {OTHER}", "s", 5), (4, None, "s", 5)]
    out = line_quality.apply_rules(make_docs(rows, ", extra int"))
    got = {r.doc_id: (r.text, r.n_chars, r.extra) for r in out.collect()}
    want = f"{PROSE}\n\n{OTHER} Twice."
    assert got == {1: (want, len(want), 5), 3: (rows[2][1], len(rows[2][1]), 5)}
    assert out.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]


def test_clean_documents_stay(spark, sf_dir):
    """Labelled data: no document of good quality is rejected unless the base check does, most junk is."""
    judged = line_quality.judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    rows = judged.join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").filter("not base_failed").collect()
    assert all(r.kept for r in rows if r.quality == 1)

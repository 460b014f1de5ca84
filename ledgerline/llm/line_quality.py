"""Line-first quality rules, in DataFrame functions only.

Every line of a text is judged by three rules (punctuation, navigation,
boilerplate; the last two know English, German, French and Spanish and go by
the line, not by the document's language); failing lines are removed, and a document whose removed lines
held too large a share of its word characters is rejected. Base figures of the
whole text (word count, repeated 8-word windows and so on) reject a document
before that. Everything is computed inside the row that holds the text: no
shuffle, no Python, and memory in proportion to one text.

Defined cases: a null or blank text has no words, fails the base check and
keeps a null or unchanged text; blank lines are kept and judged by no rule;
repeated rows are judged alike; an empty table gives an empty result. ``judge``
replaces input columns named like one that it adds; ``apply_rules`` returns every
input column, whatever its name.
"""

from __future__ import annotations

import unicodedata
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import SPACE_CLASS, let, shielded, unused, words

WINDOW_WORDS = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: Largest share of word characters that removed lines may hold.
MAX_LOST = 0.5
#: Punctuation rule: marks that prose hardly uses may fill this share of a line's visible characters.
MAX_ODD_MARKS = 0.1
ODD_MARKS = r"[#*$%&|<>{}\[\]~^=\\_]+|!{2,}|\?{2,}"
#: Punctuation rule: a line of fewer words must end a sentence or clause.
FRAGMENT_WORDS = 4
LINE_END = r"[.!?:;,…。！？\"'”’»)\]]\s*$"
#: Navigation rule: words that only separate entries, or nothing but menu words.
MENU_SEPARATORS = ("|", "»", "›", "·", "•", ">", "/")
MIN_SEPARATORS = 2
WORDS_PER_SEPARATOR = 5
#: By language: words that name menu entries, and words that only stand beside them. A line
#: of one language's words alone, with an entry among them, is a menu.
MENUS = {
    "en": ("home menu about us contact login logout log in out sign up register search sitemap site map next previous "
           "back to top skip content help faq share tweet print rss", ""),
    "de": ("home startseite menü kontakt impressum datenschutz agb anmelden abmelden registrieren suche suchen sitemap hilfe "
           "faq weiter zurück übersicht inhalt seitenanfang warenkorb konto teilen drucken newsletter rss",
           "über uns zum zur nach oben mein"),
    "fr": ("accueil menu contact connexion déconnexion inscription recherche rechercher plan aide faq suivant précédent retour "
           "sommaire panier compte partager imprimer mentions légales newsletter rss", "à propos de du nous site haut mon en"),
    "es": ("inicio menú contacto acceder salir registrarse buscar mapa ayuda faq siguiente anterior volver carrito cuenta "
           "compartir imprimir boletín rss", "sobre nosotros de del al sitio web arriba mi"),
}
MENUS = {lang: (tuple(entries.split()), tuple(beside.split())) for lang, (entries, beside) in MENUS.items()}
MENU_WORDS = tuple(sorted({w for lists in MENUS.values() for part in lists for w in part}))
#: Boilerplate rule: one word three times or more in a row may fill this share of a line's visible characters.
MAX_STUTTER = 0.5
#: Boilerplate rule: notices, in lines of at most this many words.
NOTICE_WORDS = 30
NOTICE_EN = (r"all rights reserved|cookie (?:policy|notice|settings)|(?:uses?|accept) cookies|privacy policy|"
             r"terms (?:of (?:use|service)|and conditions)|enable javascript|lorem ipsum|click here|subscribe (?:now|to our)|"
             r"read more|powered by|follow us|sign up for|share this")
#: Notices of other languages, at a line's start or after a blank or parenthesis.
NOTICES = {
    "de": (r"alle rechte vorbehalten|verwende[nt] cookies|cookies (?:akzeptieren|zulassen|ablehnen)|cookie-?(?:richtlinie|einstellungen|hinweis)|"
           r"datenschutz(?:erklärung|hinweise|bestimmungen)|nutzungsbedingungen|allgemeine geschäftsbedingungen|"
           r"javascript (?:aktivieren|einschalten)|(?:hier klicken|klicken sie hier)|jetzt abonnieren|newsletter (?:abonnieren|bestellen)|"
           r"folge(?:n sie)? uns|artikel (?:teilen|drucken)"),
    "fr": (r"tous droits réservés|politique de (?:cookies|confidentialité)|utilise (?:des|les) cookies|(?:accepter|refuser|gérer) (?:les |des )?cookies|"
           r"conditions (?:générales d['’](?:utilisation|achat)|d['’]utilisation)|mentions légales|activer javascript|cliquez ici|"
           r"abonnez-vous|suivez-nous|inscrivez-vous|partage[rz] cet article"),
    "es": (r"todos los derechos reservados|política de (?:cookies|privacidad)|(?:utiliza|usa|utilizamos|usamos|aceptar|rechazar) (?:las )?cookies|"
           r"aviso legal|condiciones de uso|términos (?:y condiciones|de (?:uso|servicio))|(?:activar|active|habilite) javascript|"
           r"ha(?:ga|z) clic aquí|suscríb(?:ete|ase)|síguenos|compart(?:e|ir) este artículo"),
}


def _any_accent(pattern: str) -> str:
    """Each letter with an accent also as a capital and without it: ``(?i)`` alone folds A to Z only."""
    def loose(c: str) -> str:
        return c if c.isascii() or not c.isalpha() else f"[{c}{c.upper()}{unicodedata.normalize('NFD', c)[0]}]"

    return "".join(map(loose, pattern))


NOTICE = f"(?i){NOTICE_EN}|(?:^|[ \t(])(?:{_any_accent('|'.join(NOTICES.values()))})"


def _visible(text: Column) -> Column:
    return F.length(F.regexp_replace(text, SPACE_CLASS + "+", ""))


def _matched(text: Column, pattern: str) -> Column:
    """Characters that the pattern's matches cover."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def repeated_window_words(found: Column, window: int = WINDOW_WORDS) -> Column:
    """Words of the array that lie in a ``window``-word run found twice or more, first runs included."""
    def of(hashes: Column) -> Column:
        last = F.size(hashes) - window
        runs = F.when(last >= 1, F.transform(
            F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
            lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(window)]))).otherwise(
                F.array().cast("array<bigint>"))
        return let(runs, lambda r: F.when(F.size(F.array_distinct(r)) == F.size(r), F.lit(0)).otherwise(covered(r)))

    def covered(runs: Column) -> Column:
        in_order = F.sort_array(F.transform(runs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(in_order, lambda s: let(repeats(s), spread))

    def repeats(s: Column) -> Column:
        """Starts of the runs that have an equal, ascending."""
        equal = F.filter(s, lambda x, j: (F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False))
                                          | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False))))
        return F.sort_array(F.transform(equal, lambda x: x["i"]))

    def spread(starts: Column) -> Column:
        gaps = F.transform(starts, lambda p, j: F.least(F.lit(window),
                                                        F.coalesce(F.get(starts, j + 1) - p, F.lit(window))))
        return F.aggregate(gaps, F.lit(0), lambda total, g: total + g)

    return let(F.transform(found, lambda w: F.xxhash64(w)), of)


def base_figures(text: Column) -> Column:
    """Struct of the whole text's figures; null counts as an empty text."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))

    def of(found: Column) -> Column:
        return F.struct(
            F.size(found).cast("long").alias("n_words"),
            _visible(whole).cast("long").alias("word_chars"),
            _matched(whole, r"[#*$%&|<>]+").cast("long").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            repeated_window_words(found).cast("long").alias("n_repeat_words"))

    return let(words(whole), of)


def _stuttered(found: Column) -> Column:
    """Characters of the words that stand in a row of three or more equal ones."""
    def part(word: Column, i: Column) -> Column:
        same = [F.coalesce(F.get(found, i + k) == word, F.lit(False)) for k in (-2, -1, 1, 2)]
        return (same[0] & same[1]) | (same[1] & same[2]) | (same[2] & same[3])

    return F.aggregate(F.filter(found, part), F.lit(0), lambda total, w: total + F.length(w))


def _all_menu(found: Column) -> Column:
    """True if all words but marks are menu words of one language, entries among them."""
    def bare(word: Column) -> Column:
        return F.lower(F.regexp_replace(word, r"[^\p{L}\p{N}]+", ""))

    def in_language(entries: tuple[str, ...], beside: tuple[str, ...]) -> Column:
        return (F.forall(found, lambda w: bare(w).isin("", *entries, *beside))
                & F.exists(found, lambda w: bare(w).isin(*entries)))

    # the words of all languages first: most lines are done after their first word
    return (F.forall(found, lambda w: bare(w).isin("", *MENU_WORDS))
            & reduce(lambda a, b: a | b, [in_language(*lists) for lists in MENUS.values()]))


def line_fails(line: Column) -> Column:
    """True if a rule removes the line; false for a blank line.

    Patterns repeat single characters only and rows of words are compared as
    arrays: a pattern that repeats groups would recurse once per repetition
    and overflow the stack on a very long line.
    """
    def of(found: Column) -> Column:
        n = F.size(found)
        odd = _matched(line, ODD_MARKS) > MAX_ODD_MARKS * _visible(line)
        fragment = (n < FRAGMENT_WORDS) & ~line.rlike(LINE_END)
        marks = F.size(F.filter(found, lambda w: w.isin(*MENU_SEPARATORS)))
        menu = ((marks >= MIN_SEPARATORS) & (marks * WORDS_PER_SEPARATOR >= n)) | _all_menu(found)
        notice = (n <= NOTICE_WORDS) & line.rlike(NOTICE)
        return (n > 0) & (odd | fragment | menu | notice | (_stuttered(found) > MAX_STUTTER * _visible(line)))

    return let(words(line), of)


def clean_lines(text: Column) -> Column:
    """Struct of the text without its failing lines and the word characters it lost."""
    def of(judged: Column) -> Column:
        stay = F.filter(judged, lambda x: ~x["fails"])
        lost = F.aggregate(F.filter(judged, lambda x: x["fails"]), F.lit(0).cast("long"),
                           lambda total, x: total + _visible(x["line"]).cast("long"))
        return F.struct(F.when(F.size(stay) == F.size(judged), text)
                        .otherwise(F.array_join(F.transform(stay, lambda x: x["line"]), "\n")).alias("text"),
                        lost.alias("lost_chars"))

    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    return let(F.transform(lines, lambda line: F.struct(line.alias("line"), line_fails(line).alias("fails"))), of)


ADDED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "lost_chars",
         "clean_text", "kept")


def judge(df: DataFrame, text: str = "text", max_lost: float = MAX_LOST) -> DataFrame:
    """``df`` with the base figures, ``clean_text``, ``lost_chars`` and the verdicts ``base_failed`` and ``kept``."""
    df = df.drop(*ADDED)
    own = unused(df, "_found")
    found = F.struct(base_figures(F.col(text)).alias("base"), clean_lines(F.col(text)).alias("lines"))
    # A generator of one row: filters on its output stay above it, so texts are judged once.
    rows = df.withColumn(own, F.explode(F.array(found)))
    base, lines = F.col(f"{own}.base"), F.col(f"{own}.lines")
    base_failed = ((base["n_words"] < MIN_WORDS)
                   | (100 * base["n_repeat_words"] > MAX_REPEAT_PERCENT * base["n_words"]))
    small_loss = lines["lost_chars"] <= F.lit(max_lost) * base["word_chars"]
    return rows.select(*[F.col(f"`{c}`") for c in df.columns], f"{own}.base.*", base_failed.alias("base_failed"),
                       lines["lost_chars"].alias("lost_chars"), lines["text"].alias("clean_text"),
                       (~base_failed & small_loss).alias("kept"))


def apply_rules(df: DataFrame, text: str = "text", chars: str = "n_chars", max_lost: float = MAX_LOST) -> DataFrame:
    """Kept documents with their cleaned text, in the columns of ``df``; ``chars`` follows the text where present."""
    inner, at = shielded(df)
    kept = judge(inner, at[text], max_lost).filter("kept")
    new = {at[text]: F.col("clean_text")}
    if chars in at:
        new[at[chars]] = F.length("clean_text").cast(df.schema[chars].dataType)
    return kept.withColumns(new).select(*inner.columns).toDF(*df.columns)

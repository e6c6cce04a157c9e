import random
import re

import numpy as np
import pyarrow as pa

from weftlink.llm import abuse
from weftlink.llm.queries import QUERIES
from conftest import SMALL

CALM = ["The council met on Monday and passed a vote of thanks.", "Best in show went to the mayor's dog.", "Flax was firm and coal dull at the market.", "The engineer estimated the bridge at 47 pounds."]
FOUL = ["You filthy stinking scum, I would thrash you and hang you.", "That worthless bastard is a lying swine and ought to drown."]


def pages(n=160):
    rows, votes = [], []
    for i in range(n):
        bad = i % 4 == 0
        words = [CALM[i % 4], CALM[(i + 1) % 4]] + ([FOUL[i // 4 % 2]] if bad else [])
        rows.append((i, "\n".join(words * (1 if bad else 1 + i % 3)), f"s{i % 2}" if i % 5 else None))
        votes.append((i, "x", int(bad)))
    return rows, votes


def frames(spark, rows, votes):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS key", "2 AS w", "3 AS score", "4 AS y", "5 AS fold")
    return docs, spark.createDataFrame(votes, "doc_id long, annotator string, abusive int")


def test_held_out_pages(spark):
    rows, votes = pages()
    extra = [(900, FOUL[0], "s1"), (901, CALM[0], "s1"), (902, None, "s1"), (903, "", None), (904, "  \n ", "s0"), (905, (CALM[1] + " ") * 3000, "s0"), (906, "You fil-\nthy stinking scum, I would thr4sh you and hang you.", "s0")]
    docs, labels = frames(spark, rows + extra, votes)
    got = {r["doc_id"]: r["score"] for r in abuse.scores(docs, labels).collect()}
    assert len(got) == len(rows) + len(extra) and all(0 <= s <= 1 for s in got.values())
    right = sum((got[i] >= 0.5) == bool(y) for i, _, y in votes)
    assert right >= 0.95 * len(votes)
    assert got[900] >= 0.5 and got[906] >= 0.5 and max(got[i] for i in (901, 902, 903, 904, 905)) < 0.5
    rates = {r["source"]: r for r in abuse.rates(abuse.scores(docs, labels), docs).collect()}
    assert sum(r["pages"] for r in rates.values()) == len(rows) + len(extra) and None in rates


UNSEEN = [
    "You stupid ugly bitch, I will strangle you and burn your house.", "Tu es une ordure et un menteur, je vais te tuer.",
    "Eres una basura y un cerdo, te voy a matar.", "Du dreckiges Schwein, ich werde dich erschlagen.",
]
HARMLESS = ["You are kindly asked to send your letters to the editor.", "Vous trouverez votre journal chez le libraire.", "Usted puede comprar su pan en la plaza.", "Dein Brief und deine Karte kamen am Montag an."]
LEARNT = FOUL + ["Salaud, connard, tu es une pute et je vais te frapper.", "Puta asquerosa, eres una mierda, te voy a golpear.", "Arschloch, du Hure, ich will dich schlagen und verbrennen."]


def test_sentences_never_seen_in_four_languages(spark):
    rows, votes, r = [], [], random.Random(1)
    known = {w for t in UNSEEN for w in re.findall(r"\w+", t.lower())}
    pick = {k: sorted(set(v.split()) - known) for k, v in abuse.LISTS.items()}
    for i in range(400):  # abusive words that hardly ever repeat
        bad = i % 4 == 0
        foul = f"{r.choice(pick['you'])} {r.choice(pick['insult'])} {r.choice(pick['insult'])}, {r.choice(pick['threat'])}"
        rows.append((i, " ".join([r.choice(CALM), r.choice(CALM)] + ([foul] if bad else [r.choice(pick["you"])])), "s"))
        votes.append((i, "x", int(bad)))
    extra = [(900 + i, f"{CALM[i % 4]} {t}", "s") for i, t in enumerate(UNSEEN + HARMLESS)]
    docs, labels = frames(spark, rows + extra, votes)
    got = {r["doc_id"]: r["score"] for r in abuse.scores(docs, labels).collect()}
    assert min(got[900 + i] for i in range(4)) >= 0.5 > max(got[904 + i] for i in range(4))


def test_too_few_labels_and_no_pages(spark):
    docs, labels = frames(spark, [(1, FOUL[0], "a"), (2, CALM[0], "a"), (3, None, "a")], [(1, "x", 1), (1, "y", 0), (2, "x", 0)])
    assert {r["doc_id"]: r["score"] for r in abuse.scores(docs, labels).collect()} == {1: None, 2: None, 3: None}
    assert abuse.rates(abuse.scores(docs, labels), docs).first()["abusive"] is None
    assert abuse.scores(docs.limit(0), labels.limit(0)).collect() == []


def test_windows_stop_at_a_page_s_end():
    lists = pa.array([["you", "scum"], [], ["filthy", "swine"], None], pa.list_(pa.string()))
    x = abuse.features(abuse._code(lists), abuse.Lexicon(np.zeros(0, np.uint64), np.zeros(0)))
    insult = abuse.FEATURES.index("insult")
    assert x[:, insult].tolist() == [1, 0, 2, 0]


def test_canonical_folds_misreadings():
    assert abuse.canonical("Fi1thy") == abuse.canonical("filthy") and abuse.canonical("VERMÍN") == abuse.canonical("vermin")


def test_pages_of_the_table(spark):
    """Scores of every page, once, and higher on pages voted abusive."""
    d = SMALL.replace("sf0.001", "sf0.01")
    scores = QUERIES["p10_scores"](spark, d).toPandas().set_index("doc_id").score
    assert scores.index.is_unique and len(scores) == spark.read.parquet(f"{d}/documents.parquet").count()
    votes = spark.read.parquet(f"{d}/page_labels.parquet").groupBy("doc_id").avg("abusive").toPandas().set_index("doc_id")["avg(abusive)"]
    assert scores[votes.index[votes > 0.5]].mean() > 2 * scores[votes.index[votes < 0.5]].mean()
    assert QUERIES["p10_found"](spark, d).columns == ["doc_id"]

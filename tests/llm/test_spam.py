"""Own content of mails, features, trees, and scores."""

import base64
import random

import numpy as np
import pytest

from weftline.llm.mail import is_note, own_content
from weftline.llm.spam import FIRST_SPAM, SIGNALS, bag, features, page_features, predict, spam_scores, weak_label
from weftline.plans.runtime import table

HEAD = "From: Ann <ann@host.test>\nSubject: x\n"
SENTENCES = "We moved the review to 9 May because the report was not ready. Please send me the list before Friday."
LINKS = "\n".join(f"http://shop{i}.test/offer-{i}" for i in range(12))
KEYWORDS = "watches cheap, garden hose discount, watches best, sofa, garden hose sale, watches near me, sofa cheap, garden hose, watches online, sofa deal, watches buy, sofa best"


def mail(body, extra=""):
    return f"{HEAD}{extra}\n{body}"


@pytest.mark.parametrize(
    "text,own",
    [
        (None, ""), ("", ""), (" \n ", ""), (mail(""), ""), ("no header at all", "no header at all"),
        (mail(f"Dear Bob,\n\n{SENTENCES}\n\nKind regards\nAnn\nWelder"), SENTENCES),
        (mail(f"{SENTENCES}\n-- \nAnn"), SENTENCES),
        (mail(f"{SENTENCES}\n\nOn Mon, 5 Dec 2022, Bob wrote:\n> {LINKS.splitlines()[0]}\n> more"), SENTENCES),
        (mail(f"Bob wrote on Mon, 5 Dec 2022:\n> {KEYWORDS}\n\nHi,\n{SENTENCES}"), SENTENCES),
        (mail(f"{SENTENCES}\n\n-----Original Message-----\nFrom: Bob\n{KEYWORDS}"), SENTENCES),
        (mail(base64.encodebytes(SENTENCES.encode()).decode(), "Content-Type: text/plain; charset=utf-8\nContent-Transfer-Encoding: base64\n"), SENTENCES),
        (mail("Caf=C3=A9 =\nopen", "Content-Transfer-Encoding: quoted-printable\n"), "Café open"),
        (mail("<html><body><p>One &amp; two</p><blockquote>no</blockquote><p>three</p></body></html>", "Content-Type: text/html\n"), "One & two\nthree"),
        (mail("--B\nContent-Type: text/plain\n\nfirst\n--B\nContent-Type: text/html\n\n<p>second</p>\n--B--", 'Content-Type: multipart/alternative; boundary="B"\n'), "first"),
        (mail("--B\nContent-Type: text/plain\n\nfirst\n--B\nContent-Type: application/pdf\nContent-Disposition: attachment\n\nAAAA", "Content-Type: multipart/mixed; boundary=B\n"), "first"),
        (mail(SENTENCES.replace(" ", "\r\n", 1)).replace("\n", "\r\n"), SENTENCES.replace(" ", "\n", 1)),
    ],
)
def test_own_content(text, own):
    assert own_content(text).split() == own.split()


TABLE = "\n".join(";".join(str((i * j * 37) % 991) for j in range(1, 6)) for i in range(20))
LOG = "\n".join(f"2024-01-0{i % 9 + 1} 10:00:0{i % 9} INFO [worker-1] batch {i} done in 7 ms" for i in range(20))
TAGS = "#cheapsofa #bestwatches #dealloans " * 8


def test_weak_labels():
    named = lambda t: (lambda k: SIGNALS[k] if k >= 0 else None)(weak_label(features(t)))
    assert [named(t) for t in (LINKS, TAGS, "\n".join([KEYWORDS.replace(",", "")] * 3), "\n".join([KEYWORDS] * 2))] == ["links", "tags", "repeats", "items"]
    assert [named(t) for t in (SENTENCES, LOG, TABLE, "yes :)", "", "see http://a.test/x", "can you ring me back after lunch about this")] == ["prose", "log", "numbers", "note", "note", "note", "talk"]
    assert [named(t) for t in (KEYWORDS, SENTENCES * 3 + "\n" + LINKS, "ring Ben after lunch re lamp order and lists")] == [None] * 3  # the trees tell


def test_deep_parts():
    text = SENTENCES
    for i in range(30):
        text = f"Content-Type: multipart/mixed; boundary=B{i}\n\n--B{i}\n{text if i else 'Content-Type: text/plain' + chr(10) * 2 + text}\n--B{i}--"
    assert own_content(text) == SENTENCES


@pytest.mark.parametrize(
    "line,note",
    [
        ("This e-mail is confidential and intended for the recipient.", True), ("The sender accepts no liability for the opinions of the author.", True),
        ("Diese Nachricht ist vertraulich und nur für den Empfänger.", True), ("Please delete the old list.", False), ("The review is on Friday and we need the report.", False),
    ],
)
def test_notes(line, note):
    assert is_note(line) == note


def test_trees_learn_and_repeat():
    rng = np.random.default_rng(0)
    x = rng.random((600, 4))
    y = ((x[:, 1] > 0.6) & (x[:, 3] < 0.7)).astype(int)
    signal = np.where(y == 1, FIRST_SPAM, 0)
    model = bag(x[:400], signal[:400])
    assert ((predict(model, x[400:]) > 0.5) == y[400:]).mean() > 0.95
    assert model == bag(x[:400], signal[:400])
    assert predict([0.25], x).tolist() == [0.25] * 600


def test_open_mails_are_told_apart(spark):
    """Accuracy on mails of a kind known beforehand, none of which has a weak label."""
    rng = random.Random(5)
    things, offers = "lamp kettle tyre carpet ladder mixer blender heater".split(), "cheap best sale now buy deal".split()
    opening = "ring Ben after lunch re lamp order|page two of report missing again|van waits outside gate nine|budget meeting moved, room still open".split("|")
    said = "We need the second list before the review starts on Monday.|Nobody told me about this, so I went home before four.|Can you ask them if they have the old report?".split("|")
    spam_text = lambda: rng.choice(opening) + "\n" + " ".join(f"{rng.choice(offers)} {rng.choice(things)}{rng.choice([',', '', ' |'])}" for _ in range(rng.randint(9, 16)))
    plain_text = lambda: "\n".join(rng.sample(opening, rng.randint(1, 2))) + "\n" + rng.choice(said) + rng.choice(["", "\nhttp://a.test/x"])
    known = [(10**6 + i, mail(spam_text() if i % 2 else plain_text())) for i in range(200)]
    known = [(i, t) for i, t in known if weak_label(features(own_content(t))) == -1]
    assert len(known) >= 170
    documents = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text").unionByName(spark.createDataFrame(known, "doc_id long, text string"))
    got = {r.doc_id: r.score > 0.5 for r in spam_scores(documents).where("doc_id >= 1000000").collect()}
    assert sum(got[i] == bool(i % 2) for i, _ in known) >= 0.98 * len(known)


def test_host_rates_move_scores(spark):
    """Of two equal mails the one whose host sends spam besides has the higher score."""
    spam_of = lambda host, text: (f"From: a@{host}\n\n{text}",)
    rows = [spam_of("bad.test", LINKS)] * 30 + [spam_of("good.test", SENTENCES)] * 30 + [spam_of(h, KEYWORDS) for h in ("bad.test", "good.test")]
    documents = spark.createDataFrame([(i, t) for i, (t,) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r for r in spam_scores(documents).collect()}
    assert got[60].page_score == got[61].page_score and got[60].score > got[60].page_score and got[61].score < got[61].page_score


def test_scores(spark):
    texts = [mail(f"Dear Bob,\n\n{SENTENCES}" * (1 + i % 3)) for i in range(60)] + [mail(LINKS if i % 2 else TAGS) for i in range(20)] + [mail(t) for t in (LOG, TABLE)] * 5
    rows = list(enumerate(texts)) + [(60, mail(TAGS)), (200, None), (201, ""), (202, "  "), (203, mail("see http://a.test/x")), (None, mail(TAGS)), (204, "x" * 200_000)]
    got = spam_scores(spark.createDataFrame([(i, t, "h", 1.0) for i, t in rows], "doc_id long, text string, host string, score double")).collect()
    assert len(got) == len(rows)
    spam = sorted(-1 if r.doc_id is None else r.doc_id for r in got if r.score > 0.5)
    assert spam == sorted([-1, 60, *range(60, 80)])


def test_no_rows_or_one_label(spark):
    schema = "doc_id long, text string"
    assert spam_scores(spark.createDataFrame([], schema)).count() == 0
    assert [r.score for r in spam_scores(spark.createDataFrame([(1, mail(SENTENCES))], schema)).collect()][0] < 0.1


@pytest.mark.parametrize(
    "text,host",
    [
        (mail("Hello"), "host.test"),
        ("Received: by relay.test\r\n" * 400 + "From: Ann <ann@far.test>\r\n\r\nHello", "far.test"),
        ("X: " + "y" * 3980 + "\nFrom: ann@cut.example.test\n\nHello", "cut.example.test"),
        ("\n \nFROM: ann@Led.test\nSubject: x\n\nHello", "led.test"),
        ("Subject: x\n\nfrom: bob@quoted.test", None), ("Subject: x\n \t\nFrom: bob@quoted.test", None), ("From: nobody\n", None), ("", None), (None, None),
    ],
)
def test_sender_stands_anywhere_in_the_header_block(spark, text, host):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert [r.host for r in page_features(df).collect()] == [host]

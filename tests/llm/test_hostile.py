"""Texts that would stop a job: very long runs of one kind, and secrets in every position."""

import time

import pytest
import tiktoken
from pyspark.sql import functions as F

from pulsegrid.llm import automaton, chat, divergence, hosts, pieces, surrogates, tokens
from pulsegrid.llm.registry import RANKS, VOCABULARY

RUNS = {"blank": " ", "break": "\n", "tab": "\t", "letter": "x", "digit": "7", "sign": "+", "wide": "日", "mixed": " \n"}


@pytest.fixture(scope="module")
def long_texts(spark):
    """Two million of each character, in a text that has words around them."""
    rows = [(i, f"one two{c * (2_000_000 // len(c))}three four. {c}", "en", "s") for i, c in enumerate(RUNS.values())]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(len(rows)).cache()


def timed(df, limit=120):
    begun = time.perf_counter()
    rows = df.collect()
    assert time.perf_counter() - begun < limit
    return rows


def test_long_runs_are_encoded(long_texts):
    rows = timed(tokens.attributed(long_texts, tokens.load(RANKS)).groupBy("doc_id").agg(F.sum("n_tokens").alias("n")))
    assert len(rows) == len(RUNS) and all(r.n > 5 for r in rows)


@pytest.mark.parametrize("c", [" ", "\n", "\t", " \n", " ", "\r\n"])
def test_long_white_space_is_cut_where_the_pattern_cuts(c):
    encoder = tokens.Encoder(tokens.load(RANKS), tokens.PATTERN)
    plain: tiktoken.Encoding = encoder.encoding
    for n in (9_999, 10_000, 10_001, 25_000):
        for text in (c * n, c * n + "word", "word" + c * n, "a 1" + c * n + "!b" + c * n + " c", c * n + "é"):
            assert encoder.ids(text) == plain.encode_ordinary(text)


def test_long_runs_in_the_other_operators(long_texts):
    assert len(timed(automaton.scored(long_texts, F.lit(True)))) == len(RUNS)
    timed(divergence.audit(long_texts, least=1))
    timed(surrogates.surrogate_spans(long_texts, b"k").select("doc_id", "n_entities"))
    assert all(r.same for r in timed(pieces.round_trips(long_texts.where("doc_id < 5"), pieces.load(VOCABULARY)).select(
        F.lit(True).alias("same"))))


def test_white_space_of_a_turn_is_trimmed_in_time(spark):
    text = "User: a" + " " * 1_000_000 + "b" + " " * 300_000 + "\n" + "\n" * 100_000
    rows = spark.createDataFrame([(1, 0, text, "user")], "c long, t long, raw string, role string")
    model = chat.fit(rows, "c", [F.col("t")], "raw")
    (turn,) = timed(chat.parsed(rows, model, "c", [F.col("t")], "raw").where("turn = 0"))
    assert turn.text.startswith("<|im_start|>") and turn.text.endswith("b<|im_end|>")


JWT = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0NTY3ODkwIn0.dozjgNryP4J3jVmNHl0w5N_XgL0n3I9PlFUP0THsR8U"
SECRETS = [
    ("DB_PASSWORD={}", "abc12345"), ("client_secret={}", "abc12345xyz"), ("Authorization: Bearer {}", JWT), ("see {} there", JWT),
    ("see {}", "github_pat_11ABCDEFG0aBcDeFgHiJkL_0123456789abcdef"), ("x {} y", "xoxb-123456789012-abcdefGHIJKL"), ("Passwort: {}", "geheim123"),
    ('password="{}"', "p@ssw0rd!long"), ("password={}", "abc123!xyzQ9"), ("password := '{}'", "two words 12"), ("token => {}.", "q1w2e3r4"),
    ("Token: Basic {}", "YWRtaW46cGFzczEy"), ("api-key: {}", "a1b2c3d4e5"), ("contraseña={}", "clave9876"), ("(pwd={})", "zxcvbn99"),
]


@pytest.mark.parametrize("shape,value", SECRETS)
def test_secrets_go_in_every_position(shape, value):
    s = surrogates.Surrogates(b"k")
    inner = shape.format(value)
    for text in (inner, f"Start {inner}", f"A line\n{inner}\nlast", f"{inner} and again {value}, or ({value})"):
        new, spans = surrogates.replaced(text, s)
        assert value not in new and len(new) == len(text), text
        assert len({sp[4] for sp in spans if sp[3] == value}) <= 1  # one secret, one surrogate
        # a key's fixed beginning tells its kind and stays
        pieces_left = [value[i:i + 6] for i in range(11 if value.startswith("github") else 0, len(value) - 5) if value[i:i + 6] in new and value[i:i + 6].isalnum()]
        assert not pieces_left, (text, pieces_left)


@pytest.mark.parametrize("text", ["+49 (0)171 1234567", "+44 20 79460958"])
def test_phones_of_long_groups(text):
    new, spans = surrogates.replaced(f"call {text} now", surrogates.Surrogates(b"k"))
    assert [sp[2:4] for sp in spans] == [("phone", text)] and text not in new


def test_hosts_without_evidence_are_allowed(spark):
    """A domain without votes, in a suffix of bad ones, is no reason to block; its own bad votes are."""
    votes = [(f"h{i}.bad{i}.net", 1) for i in range(40)] + [("new.other.org", None), ("a.fresh.net", None)]
    votes += [("www.spam.org", 1)] * 30 + [("www.fine.net", 0)] * 30 + [("x.spam.org", None)]
    got = {r.host: r for r in hosts.reputation(spark.createDataFrame(votes, "host string, outcome int")).collect()}
    assert got["new.other.org"].near == got["a.fresh.net"].near == 0
    assert got["www.spam.org"].bound > 0.5 > got["www.fine.net"].bound and got["www.fine.net"].rate < 0.2
    # uncertainty adds up on the way down: less is sure of a host without votes than of its domain's own
    assert got["x.spam.org"].near == 30 and got["x.spam.org"].bound < got["www.spam.org"].bound
    assert got["new.other.org"].bound < got["x.spam.org"].bound

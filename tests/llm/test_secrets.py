import hashlib
import random
import re
from math import log2

from corpweave.llm import secrets

from .conftest import AWKWARD, pairs


def brute_base(text):
    spans = []
    assign = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    spans += [(m.start(), "assign", m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 6]
    spans += [(m.start(), "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    order = ["assign", "access", "hex"]
    return sorted(spans, key=lambda s: (s[0], order.index(s[1])))


def made_texts(n=300):
    rng = random.Random(4)
    bits = ["password=", "Token : '", "API_KEY=\"", "passwd:ab", "AKIA", "AKIA" + "Q7" * 8, "0a" * 12, "f" * 23, "ſecret=abcdefgh",
            "secret = hunter2hunter2", " ", "\n", "word", "=", "'", '"', "İ", "éè", "deadbeef" * 4, "Zk9+/aQ" * 4]
    return ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 12))) for _ in range(n)]


def test_base_spans_against_plain_patterns():
    for text in made_texts():
        got = [(a, kind, b) for a, b, kind in secrets.in_order(secrets.base_spans(text))]
        assert got == brute_base(text), text


def test_entropy_windows_against_direct_entropy():
    rng = random.Random(1)
    for _ in range(40):
        run = "".join(rng.choice("abcdef0123456789XYZ+/") for _ in range(rng.randrange(20, 60)))
        wanted = []
        for at in range(len(run) - secrets.WINDOW + 1):
            w = run[at : at + secrets.WINDOW]
            digits, lower, upper = (sum(map(f, w)) for f in (str.isdigit, str.islower, str.isupper))
            kind = secrets.window_class({}, digits, lower, upper, sum(c not in "0123456789abcdef" for c in w))
            entropy = -sum(w.count(c) / len(w) * log2(w.count(c) / len(w)) for c in set(w))
            if kind and entropy >= secrets.THRESHOLDS[kind] - 1e-9:
                wanted.append(at)
        assert list(secrets.entropy_windows(run)) == wanted


def test_allow_list_words_and_finds():
    found = lambda t: [k for _, _, k in secrets.all_spans(t)]
    assert found("id 123e4567-e89b-12d3-a456-426614174000 and Donaudampfschifffahrtsgesellschaft") == []
    assert found("sha256-" + "Ab3" * 14 + "=") == []
    assert found("key zX9vQ2mL8rT4wK7pB1nC5hJ3 here") == ["entropy"]
    assert secrets.redacted("a password=abcdef1 b", secrets.all_spans("a password=abcdef1 b")) == "a <SECRET> b"


def brute_windows(part):
    """Whether any window of a string reaches its class's entropy, counted anew for each."""
    grouped = any(
        re.fullmatch("[a-z0-9]{12,}", g) and re.search("[0-9][a-z]+[0-9]", g) for g in re.split("[^A-Za-z0-9]", part)
    )
    for at in range(len(part) - secrets.WINDOW + 1):
        w = part[at : at + secrets.WINDOW]
        bare = [c for c in w if not (grouped and c in "-_")]
        digits, lower, upper = (any(map(f, bare)) for f in (str.isdigit, str.islower, str.isupper))
        plain = all(c.isalnum() for c in bare)
        if not digits or not (lower or upper or not plain):
            continue
        if all(c in "0123456789abcdef" for c in bare):
            kind = "hex"
        elif plain and not (lower and upper):
            kind = "alnum"
        elif lower and upper:
            kind = "base64"
        else:
            continue
        entropy = -sum(w.count(c) / len(w) * log2(w.count(c) / len(w)) for c in set(w))
        if entropy >= secrets.THRESHOLDS[kind] - 1e-9:
            return True
    return False


def test_candidates_against_windows_counted_anew():
    rng = random.Random(8)
    groups = ["prod", "eu", "v2", "4f8a2b9c1d7e", "9a8b7c6d5e4f", "2024", "release", "x86", "Ab9Zk3Qw8Lm2", "report1a2", "0815"]
    seen = set()
    for _ in range(400):
        text = rng.choice("-_/").join(rng.choice(groups) for _ in range(rng.randrange(2, 9)))
        if len(text) < secrets.WINDOW or secrets.ALLOWED.fullmatch(text):
            continue
        wanted = [(0, len(text), "entropy")] if brute_windows(text) else []
        assert secrets.entropy_spans(text) == wanted, text
        seen.add(bool(wanted))
    assert seen == {True, False}


def test_keys_in_groups_and_whole_keys():
    for key in ("prod-eu-4f8a2b9c1d7e-9a8b7c6d5e4f", "sk_live_4ec39hqlyjwd", "Qwertzuiopasdf" + "9aZ3xK7pL2mN8vB4cD6fG1hJ" + "yxcvbnmlkjh"):
        text = f"use {key}, please"
        assert secrets.entropy_spans(text) == [(4, 4 + len(key), "entropy")], key
        assert secrets.redacted(text, secrets.all_spans(text)) == "use <SECRET>, please"
    assert secrets.entropy_spans("aws_value=zX9vQ2mL8rT4wK7pB1nC5hJ3") == [(10, 34, "entropy")]
    both = "zX9vQ2mL8rT4wK7pB1nC5hJ3=qW3eR5tZ7uI9oP1aS2dF4gH6jK8l"
    assert secrets.entropy_spans(both) == [(0, len(both), "entropy")]
    for plain in (
        "release-notes-v2-build3-linux-x86_64",
        "files/123e4567-e89b-12d3-a456-426614174000/cover-page-2",
        "blog/2024/10/21/what-we-learned-from-3-years",
        "the-quick-brown-fox-jumps-over-13-lazy-dogs",
    ):
        assert secrets.entropy_spans(plain) == [], plain


def test_digests_and_spans_of_awkward_rows(spark, awkward, nothing):
    got = pairs(secrets.secret_digests(awkward), "doc_id", "n_hex", "base_sha256", "spans")
    empty = hashlib.sha256(b"").hexdigest()
    assert got == sorted([(i, 0, empty, "") for i, _ in AWKWARD], key=repr)
    assert secrets.secret_digests(nothing).count() == 0
    docs = spark.createDataFrame([(9, "x token = '0123456789abcdef01234567'")], "doc_id bigint, text string")
    rows = {r["kind"]: r for r in secrets.scan_secrets(docs).collect()}
    assert rows["hex"]["found"] == "0123456789abcdef01234567" and rows["assign"]["span_start"] == 2
    cleaned = secrets.redact_secrets(awkward.unionByName(docs, allowMissingColumns=True))
    assert cleaned.columns == awkward.columns and cleaned.where("text IS NULL").count() == 1
    assert cleaned.where("doc_id = 9").first()["text"] == "x <SECRET>'"

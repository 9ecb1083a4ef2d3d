import hashlib
import random
import re
import string
import time

from lodestrata.llm import secrets

EMPTY = hashlib.sha256(b"").hexdigest()


def base_by_hand(text):
    found = []
    pattern = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for m in re.finditer(pattern, text, re.IGNORECASE | re.ASCII):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, "assign", m.end()))
    for m in re.finditer("AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 20:
            found.append((m.start(), 1, "access", m.end()))
    for m in re.finditer("[0-9a-f]+", text):
        if len(m[0]) >= 24:
            found.append((m.start(), 2, "hex", m.end()))
    return sorted(found)


KEY = "AKIA" + "Q7RT2MZX9KLP4WVN"
LIVE = "password = 'zQ8!'; api_key: \"k9Xw2Lq7Vb4Tn1\""
TEXTS = [
    None,
    "",
    "nothing here",
    LIVE,
    f"é😀 {KEY} and token=ab, secret: abcdef1234",
    "PASSWORD=token:abcdefgh passwd: 'pass.word_1' ſecret=abcdefgh",
    "0123456789abcdef01234567 0123456789abcdef0123456 " + "deadbeef" * 400,
    f"AKIAAKIA{KEY} AKIAshort {'x' * 50_000} token = {'A' * 3000}",
    "ghp_" + "aZ9" * 12 + " https://user:hunter2hunter2@host/ -----BEGIN RSA PRIVATE KEY-----",
    "token=token=token=abcdefg api_key=api-key=abcdefg",
]


def test_spans_against_plain_search(documents):
    rows = [(i, text, f"s{i}") for i, text in enumerate(TEXTS)] + [(3, TEXTS[3], "s3"), (None, TEXTS[4], None)]
    found = secrets.scan_secrets(documents(rows)).collect()
    assert len(found) == len(rows)
    texts = dict(enumerate(TEXTS)) | {None: TEXTS[4]}
    for r in found:
        base = base_by_hand(texts[r["doc_id"]] or "")
        listed = ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in base)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(b[2] == k for b in base) for k in ("assign", "access", "hex")]
        spans = r["spans"].split(",") if r["spans"] else []
        assert set(filter(None, listed.split(","))) <= set(spans)
        starts = [int(s.split(":")[1]) for s in spans]
        assert starts == sorted(starts)
    by = {r["doc_id"]: r for r in found}
    assert by[0]["base_sha256"] == by[2]["base_sha256"] == EMPTY and by[0]["spans"] == ""
    assert {s.split(":")[0] for s in by[8]["spans"].split(",")} >= {"github", "url_login", "key_block"}


def test_ownership_tells_examples_from_live_ones(documents):
    rows = [(i, "docs say token=Zk3Lw9Qx7Rt5", f"owner{i}") for i in range(4)]
    rows += [(10 + i, "token=Pm4Vc8Xz1Nb6Qw", "one") for i in range(50)]
    rows += [(90, "token=your_token_here", "two"), (91, "token=aaaaaaaaaa", "two"), (92, "token=Hn5Jk2Ls8Df3", None)]
    by = {r["doc_id"]: r for r in secrets.scan_secrets(documents(rows)).collect()}
    assert all(by[i]["n_copied"] == 1 and by[i]["n_live"] == 0 for i in range(4))
    assert all(by[10 + i]["n_live"] == 1 and by[10 + i]["live_spans"] == "assign:0:20" for i in range(50))
    assert by[90]["n_live"] == by[91]["n_live"] == 0 and by[92]["n_live"] == 1


def test_repositories_and_owners_against_a_plain_count(spark, documents):
    rng = random.Random(8)
    values = [f"Qv{k}Zx{rng.randrange(10**6)}Lw" for k in range(12)]
    rows = []
    for i in range(400):
        k = rng.randrange(12)
        owner = rng.choice("ab" if k < 4 else "abcdef"[: k - 3])
        rows.append((rng.randrange(300), f"token={values[k]}", owner if rng.random() > 0.1 else None))
    rows += [(i, "token=Hn5Jk2Ls8Df3", "ab"[i % 2]) for i in range(1000, 1019)]  # two owners, 19 repositories
    docs = documents(rows)
    found = secrets.scan_secrets(docs).collect()
    wanted = {}
    for i, text, owner in rows:
        wanted.setdefault(text, set()).add((owner, i))
    copied = {}
    for text, places in wanted.items():
        owners = {owner for owner, _ in places}
        copied[text] = len(owners) >= 3 or (len(owners) > 1 and len(places) >= 20)
    texts = {}
    for i, text, owner in rows:
        texts.setdefault(i, []).append(copied[text])
    got = {}
    for r in found:
        assert r["n_copied"] + r["n_live"] == 1
        got.setdefault(r["doc_id"], []).append(r["n_copied"] == 1)
    assert {i: sorted(x) for i, x in got.items()} == {i: sorted(x) for i, x in texts.items()}
    assert set(copied.values()) == {True, False} and not copied["token=Hn5Jk2Ls8Df3"]


def test_redaction_covers_live_ones_only(documents):
    rows = [(i, "example token=Zk3Lw9Qx7Rt5 é", f"owner{i}") for i in range(4)]
    rows += [(9, "x 😀 token=Pm4Vc8Xz1Nb6Qw.", "one"), (9, "x 😀 token=Pm4Vc8Xz1Nb6Qw.", "one"), (None, None, None), (11, "", "a")]
    docs = documents(rows)
    out = secrets.redact(docs)
    assert out.schema == docs.schema
    texts = sorted(((r["doc_id"] or -1), r["text"]) for r in out.collect() if r["doc_id"])
    assert texts[-3:] == [(9, "x 😀 " + "*" * 21), (9, "x 😀 " + "*" * 21), (11, "")]  # a full stop is part of a value
    assert sum("Zk3Lw9Qx7Rt5" in (r["text"] or "") for r in out.collect()) == 4


def test_empty_table(documents):
    assert secrets.scan_secrets(documents([])).collect() == []
    assert secrets.redact(documents([])).collect() == []


def pem(seed, label="RSA ", size=1600, line="\n"):
    body = "".join(random.Random(seed).choices(string.ascii_letters + string.digits + "+/", k=size)) + "=="
    lines = [body[k : k + 64] for k in range(0, len(body), 64)]
    return line.join([f"-----BEGIN {label}PRIVATE KEY-----", *lines, f"-----END {label}PRIVATE KEY-----"])


def test_whole_keys_are_one_value_each(documents):
    cut = pem(7)[: pem(7).index("-----END")].rstrip("\n")
    wrapped = "\n".join(cut[k : k + 10] for k in range(32, len(cut), 10) if "\n" not in cut[k : k + 10])
    headed = pem(8).replace("-----\n", "-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0A1B\n\n", 1)
    keys = [pem(k) for k in range(4)] + [pem(4, "", 62), pem(5, "EC ", 162), pem(6, "OPENSSH ", 9000), cut, headed]
    keys += [pem(9, line="\\n"), pem(10, line="\r\n"), pem(11, line=" "), cut.replace("\n", "\\n") + "\\nQ8z", cut + "\nQ8z"]
    keys += [f"-----BEGIN RSA PRIVATE KEY-----\n{wrapped}"]
    rows = [(k, f"é {key}\nsome words after it", f"owner{k}") for k, key in enumerate(keys)]
    same = pem(99)
    rows += [(100 + k, f"{same} end" if k else same.replace("\n", "\r\n"), f"owner{k}") for k in range(3)]
    rows += [(200, f"{pem(20)}\n{pem(21)}", "two"), (201, "-----BEGIN RSA PRIVATE KEY----- marks the start of a key", "two")]
    by = {r["doc_id"]: r for r in secrets.scan_secrets(documents(rows)).collect()}
    for k, key in enumerate(keys):
        assert f"key_block:2:{2 + len(key)}" in by[k]["spans"].split(","), key
        assert by[k]["n_copied"] == 0 and f"key_block:2:{2 + len(key)}" in by[k]["live_spans"]
    assert all(by[100 + k]["n_copied"] == 1 and by[100 + k]["n_live"] == 0 for k in range(3))
    assert by[200]["live_spans"].count("key_block") == 2 and by[201]["spans"] == "key_block:0:31"
    texts = {r["doc_id"]: r["text"] for r in secrets.redact(documents(rows)).collect()}
    assert all(texts[k] == "é " + "*" * len(key) + "\nsome words after it" for k, key in enumerate(keys))


def test_many_headers_and_long_keys_take_linear_time():
    started = time.perf_counter()
    assert len(secrets.find_secrets("-----BEGIN PRIVATE KEY-----\n" * 20_000)) == 20_000
    long = "-----BEGIN PRIVATE KEY-----" + ("\n" + "aB3d" * 16) * 20_000 + "\nwords that end it"
    assert secrets.find_secrets(long)[0][2] == len(long) - len("\nwords that end it")
    secrets.find_secrets("-----BEGIN PRIVATE KEY-----" + " \n" * 20_000 + "!")
    assert time.perf_counter() - started < 20


def test_short_and_numeric_values_may_look_random():
    rng = random.Random(6)
    alphabets = (string.digits, "0123456789abcdef", string.ascii_lowercase, string.ascii_letters, string.ascii_letters + string.digits)
    for alphabet in alphabets:
        for n in (6, 7, 8, 10, 12, 16, 24, 40):
            values = ["".join(rng.choices(alphabet, k=n)) for _ in range(3000)]
            values = [v for v in values if not any(word in v.lower() for word in secrets.PLACEHOLDERS)]
            assert sum(secrets.looks_random(v) for v in values) >= 0.99 * len(values), (alphabet, n)
    assert not any(map(secrets.looks_random, ["aaaaaa", "000000", "000001", "A" * 3000, "your_token", "changeme1"]))


def test_short_values_of_one_owner_are_covered(documents):
    values = ["zQ8zzw", "482911", "30771204", "771904427110", "aB3aB9"]
    rows = [(k, f"password = {v} then more", f"owner{k}") for k, v in enumerate(values)]
    rows += [(50 + k, "password = 660312 then more", f"owner{k}") for k in range(3)]
    texts = {r["doc_id"]: r["text"] for r in secrets.redact(documents(rows)).collect()}
    assert not any(v in texts[k] for k, v in enumerate(values))
    assert all("660312" in texts[50 + k] for k in range(3))

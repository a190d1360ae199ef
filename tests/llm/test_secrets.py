import hashlib
import random
import re

from helpers import AWKWARD, documents, empty

from candlewick.llm import secrets

ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def brute(text):
    t = text or ""
    out = [("assign", m.start(), m.end()) for m in re.finditer(ASSIGN, t) if len(m[2]) >= 6]
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(out, key=lambda x: (x[1], ("assign", "access", "hex").index(x[0])))


def texts():
    rng = random.Random(6)
    parts = ["token=", "API_key : '", "passwd", '"secret": "', " AKIA", "AKIA9XYZ" * 3, "deadbeef" * 4, "ABC123", "x", " ", "=", "…", "ſecret=abcdefg", "Kelvin toKen=abcdefgh", ".", "0f" * 11]
    return AWKWARD + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(150)]


def test_base_spans_match_brute_force(spark):
    tx = texts()
    df = documents(spark, tx)
    got = {r.doc_id: r for r in secrets.scan(df, secrets.train(df)).collect()}
    assert len(got) == len(tx)
    for i, t in enumerate(tx):
        want = brute(t)
        r = got[i]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x[0] for x in want) for k in ("assign", "access", "hex"))
        named = [f"{k}:{a}:{b}" for k, a, b in want]
        assert r.base_sha256 == hashlib.sha256(",".join(named).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert [s for s in spans if not s.startswith("random")] == named
        assert [int(s.split(":")[1]) for s in spans] == sorted(int(s.split(":")[1]) for s in spans)


def test_models_tell_held_out_strings_apart(spark):
    rng = random.Random(9)
    prose = [" ".join(rng.choice(["market", "ordinary", "index", "value", "container", "window", "because", "reader", "system", "request"]) for _ in range(80)) for _ in range(200)]
    model = secrets.train(documents(spark, prose))
    keys = list(secrets.random_strings(random.Random(77), 400))
    names = [s for s in secrets.identifiers(random.Random(78), " ".join(prose), 400) if len(s) >= 20]
    assert sum(map(model.is_random, keys)) >= 0.9 * len(keys)
    assert sum(map(model.is_random, names)) <= 0.01 * len(names)


def prose(n=200):
    rng = random.Random(9)
    return [" ".join(rng.choice(["market", "ordinary", "index", "value", "container", "window", "because", "reader", "system", "request"]) for _ in range(80)) for _ in range(n)]


def test_lines_of_signs_are_no_secrets(spark):
    model = secrets.train(documents(spark, prose()))
    lines = [sign * n for sign in "-_=/+" for n in (20, 40, 80, 400)] + ["+" + "-" * 30 + "+" + "-" * 30 + "+", "=-" * 30, "-_" * 20, "name______________________date____________________"]
    for line in lines:
        text = f"heading\n{line}\nbody"
        assert secrets.all_spans(text, secrets.base_spans(text), model) == [], line


def test_assign_values_train_the_random_class():
    value = "Zq8-r_T5x=Lw2Pm9Kd7Vb3"
    assert (1, value) not in [(k, v) for k, v in secrets.labelled(1, "plain words", 0)]
    assert any(k == 1 and value in v for k, v in secrets.labelled(1, f"token={value}", 0))


def test_keys_joined_to_words_and_base_spans(spark):
    model = secrets.train(documents(spark, prose()))
    rng = random.Random(4)
    alnum, b64 = secrets.ALPHABET[:62], secrets.ALPHABET[:64]
    for prefix, chars, n in (("client_value_container=", alnum, 20), ("market/window/system/request/", alnum, 20), ("/market/index/request/container/reader/", alnum, 32), ("READER_SYSTEM_REQUEST_INDEX=", b64, 40)):
        hits = 0
        for _ in range(200):
            key = "".join(rng.choice(chars) for _ in range(n))
            spans = secrets.all_spans(f"see {prefix}{key}/window now", [], model)
            a = 4 + len(prefix)
            covered = sum(max(0, min(e, a + n) - max(s, a)) for s, _, e in spans)
            hits += covered >= 0.9 * n
        assert hits >= 180, (prefix, hits)
    key = "".join(rng.choice(alnum) for _ in range(40))
    text = f"{key}/AKIA{'Q7RZ' * 5}/{key}"
    base = secrets.base_spans(text)
    got = secrets.all_spans(text, base, model)
    assert [k for _, k, _ in got] == [3, 1, 3] and all(a[2] <= b[0] for a, b in zip(got, got[1:]))


def test_maximal_stretches_match_brute_force():
    rng = random.Random(8)

    def brute(x, lo):
        best = max(((sum(x[i:j]), i - j, -i, i, j) for i in range(len(x)) for j in range(i + 1, len(x) + 1)), default=(0,))
        if best[0] <= 0:
            return []
        i, j = best[3:]
        return brute(x[:i], lo) + [(lo + i, lo + j)] + brute(x[j:], lo + j)

    for _ in range(300):
        x = [rng.uniform(-3, 2) for _ in range(rng.randint(0, 25))]
        assert secrets._maximal(x) == brute(x, 0)


def test_redact_keeps_rows_and_columns(spark):
    df = documents(spark, [None, "", "my token=abcdefgh99 ok", "clean text"])
    out = secrets.redact(df, secrets.train(df)).orderBy("doc_id").collect()
    assert [r.text for r in out] == [None, "", "my [assign] ok", "clean text"]
    assert out[0].__fields__ == df.columns


def test_empty_table(spark):
    df = empty(spark)
    model = secrets.train(df)
    assert secrets.scan(df, model).count() == 0
    assert not model.is_random("a8f7e6d5c4b3a2918070")

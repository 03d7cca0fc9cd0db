import hashlib
import random
import re

from utterloom.llm import secret_scan
from utterloom.llm.secret_scan import KINDS, base_spans, built_in_samples, markov_spans, train


def brute(text):
    out = []
    for m in re.finditer(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        out += [(m.start(), m.end(), "assign")] * (len(m[1]) >= 8)
    for kind, pattern, least in (("access", "AKIA[A-Z0-9]+", 16), ("hex", "[0-9a-f]+", 32)):
        out += [(m.start(), m.end(), kind) for m in re.finditer(pattern, text) if m.end() - m.start() >= least]
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2])))


def test_base_spans():
    rng = random.Random(2)
    parts = ["token", "ſecret", "API_KEY", "apikey", "Password", "=", ":", " ", '"', "'", "abcdefgh", "AKIA", "ABCDEFGH0123", "\n", "é😀"]
    parts += ["0123456789abcdef", "deadbeef", ".", "AKI"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 16)))
        assert base_spans(text) == brute(text), text
    assert base_spans("é😀 token = 'abcdefgh'") == [(3, 20, "assign")]
    assert base_spans("token=password=abcdefgh") == [(0, 23, "assign")]


def test_held_out_accuracy():
    model = train(built_in_samples(seed=7))
    fresh = built_in_samples(n=1500, seed=99)
    caught = [model.is_secret(t) for t, label in fresh if label]
    wrong = [model.is_secret(t) for t, label in fresh if not label]
    assert sum(caught) / len(caught) > 0.97
    assert sum(wrong) / len(wrong) < 0.005


def test_method_adds_to_base():
    model = train(built_in_samples())
    text = "key Zx9Qw3LkT7vB2nM5rYp8Hs4D is not thisIsAnOrdinaryFunctionName nor a_perfectly_normal_name"
    assert [text[a:b] for a, b, _ in markov_spans(text, model, base_spans(text))] == ["Zx9Qw3LkT7vB2nM5rYp8Hs4D"]
    assert markov_spans("token = Zx9Qw3LkT7vB2nM5rYp8Hs4D", model, base_spans("token = Zx9Qw3LkT7vB2nM5rYp8Hs4D")) == []


def test_query_shape(spark):
    rows = [(1, "token = abcdefgh1", 2), (2, None, 3), (None, "", 4), (1, "token = abcdefgh1", 2)]
    d = spark.createDataFrame(rows, "doc_id long, text string, n_hex int")
    got = sorted((tuple(r) for r in secret_scan.scan(d).collect()), key=str)
    none = hashlib.sha256(b"").hexdigest()
    one = (1, 1, 0, 0, hashlib.sha256(b"assign:0:17").hexdigest(), "assign:0:17", 0)
    assert got == sorted([one, one, (2, 0, 0, 0, none, "", 0), (None, 0, 0, 0, none, "", 0)], key=str)
    assert secret_scan.scan(d.limit(0)).count() == 0
    masked = secret_scan.redact(d)
    assert masked.columns == d.columns and masked.where("text = '[secret]'").count() == 2


def test_keys_of_one_case_are_judged_too():
    model = secret_scan.train(secret_scan.built_in_samples())
    for key in ("qwxzjkvbpfghtrmnbvczlk", "QXZJKVBPWGHTRMNBVCZLKQ"):
        assert [k for _, _, k in secret_scan.markov_spans(f"see {key} there", model, [])] == ["markov"]
    for word in ("internationalization", "Wissenschaftsministerium", "RESPONSIBILITYOFADMINISTRATION"):
        assert secret_scan.markov_spans(f"see {word} there", model, []) == []

"""Operator 4: high-entropy strings of every character class."""

import random

from synthtext.llm.secrets import entropy_spans, find_secrets

LOWER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
KINDS = {"base36": (LOWER + DIGITS, 40), "base32": (LOWER.upper() + "234567", 40), "letters": (LOWER + LOWER.upper(), 40),
         "lower letters": (LOWER, 64), "upper letters": (LOWER.upper(), 64)}


def keys(alphabet, size, n, rng):
    return ["".join(rng.choice(alphabet) for _ in range(size)) for _ in range(n)]


def test_planted_keys_of_each_kind(spark):
    rng = random.Random(7)
    rows = [(kind, f"words before {k} and after") for kind, (a, n) in KINDS.items() for k in keys(a, n, 100, rng)]
    found = dict.fromkeys(KINDS, 0)
    for r in find_secrets(spark.createDataFrame(rows, "kind string, text string"), keep="kind").collect():
        found[r.kind] += r.spans.startswith("entropy:")
    assert min(found.values()) >= 95, found


def test_clean_words_are_not_keys():
    for x in ("thatreheingstandtheotherlongword", "internationalization2024edition", "RELEASENOTESFORVERSION2024",
              "Donaudampfschifffahrtsgesellschaftskapitaen", "theQuickStartGuideForTheReader", "a" * 80, "ab" * 40,
              "theendofthestoryisthatthereisnoendtothestoriesthatweheard", "section12section13section14", "ACGT" * 20):
        assert entropy_spans(x) == [], x


def test_allow_list_drops_parts_not_runs(spark):
    key, uuid = "AbC1sk9Qz7Lm2Xc4Vb8Nw1Ty6Rf3", "123e4567-e89b-12d3-a456-426614174000"
    heads = ["sample/", "example-app/key=", "your-", f"{uuid}/", "1234567890_", "EXAMPLE", f"{uuid}-{uuid}/"]
    rows = [(k, f"{h}{key}") for k, h in enumerate(heads)] + [(10, f"{key}/sample"), (11, f"{key}-example/{key[::-1]}"),
                                                             (12, uuid), (13, f"id={uuid}"), (14, "your_api_key_here_1_changeme")]
    got = {r.k: r.spans for r in find_secrets(spark.createDataFrame(rows, "k int, text string"), keep="k").collect()}
    n = len(key)
    want = {k: f"entropy:{len(h)}:{len(h) + n}" for k, h in enumerate(heads)}
    want[5] = ""  # one part
    want |= {10: f"entropy:0:{n}", 11: f"entropy:0:{n},entropy:{n + 9}:{2 * n + 9}", 12: "", 13: "", 14: ""}
    assert {k: v for k, v in got.items() if k != 1} == {k: v for k, v in want.items() if k != 1}
    start, end = map(int, got[1].split(":")[1:])
    assert len("example-") <= start <= len(heads[1]) and end == len(heads[1]) + n

"""What the windows of high entropy find, and what they leave alone."""

from __future__ import annotations

import random
import string

import pytest

from tickloom.llm.secrets import LIMITS, WINDOW, Window, entropy_spans, mask, urls

ALPHABETS = {
    "base62": string.ascii_letters + string.digits, "base64": string.ascii_letters + string.digits + "+/",
    "url64": string.ascii_letters + string.digits + "-_", "base36": string.ascii_lowercase + string.digits,
    "base32": string.ascii_uppercase + "234567", "hex": string.digits + "abcdef",
}
#: Parts of names, a third of them with digits.
PARTS = ("the of report final version approved by manager customer account number primary region long branch name file data site "
         "packages numpy core multiarray spark apache pull user local lib config server client index table python3 x86 64 win32 "
         "utf8 base64 sha256 md5 http2 ipv4 v2 v3 s3 ec2 k8s i18n mp4 h264 2023 2024 01 12 31 001 10 99").split()

LEFT_ALONE = [
    "see https://github.com/apache/spark/pull/41234/files/long-branch-name for more",
    "github.com/apache/spark/pull/41234/files/long-branch-name",
    "/usr/local/lib/python3.11/site-packages/numpy/core/multiarray",
    "C:/Users/me/Documents/2024-01-15/Report_Final_v2_approved",
    "report-final-version-2024-approved-by-manager_v3", "customer_account_number_12345_primary_region",
    "org/apache/spark/sql/execution/datasources/v2/DataSourceV2ScanExec", "x86_64-unknown-linux-gnu-1.75",
    "2024-01-15T10-30-00Z_2024-02-15T11-30-00Z", "CustomerAccountNumber12345PrimaryRegion", "=" * 40 + "1a",
    "3f2504e0-4f89-11d3-9a0c-0305e82c3301", "s3a://bucket/9xQ2mK7vL4pR8tW1zN5cJ3bH6/part",
]


@pytest.mark.parametrize("text", LEFT_ALONE)
def test_names_paths_and_urls_are_left_alone(text):
    assert entropy_spans(text) == [] and mask(text) == text


def test_values_after_a_path_are_searched():
    key = "Zk3qP9xL2vB8nM4cR7tY1wQ6"
    text = f"see https://a.example.org/files/long-branch-name?sig={key} and {key}"
    assert mask(text) == "see https://a.example.org/files/long-branch-name?[SECRET] and [SECRET]"
    assert [text[a:b] for a, b in urls(text)] == ["https://a.example.org/files/long-branch-name"]
    assert urls("no ://scheme and 9http://x") == [] and urls("a://b c+d.e://f") == [(0, 5), (6, 15)]


@pytest.mark.parametrize(("name", "length", "least"), [
    ("base62", 32, 0.93), ("base62", 40, 0.97), ("base64", 40, 0.97), ("url64", 40, 0.97), ("base36", 32, 0.96),
    ("base32", 40, 0.9), ("hex", 32, 0.99), ("base64", 64, 0.99)])
def test_share_of_random_keys_found(name, length, least):
    rng = random.Random(length)
    found, covered = 0, 0.0
    for _ in range(1000):
        spans = entropy_spans("key " + "".join(rng.choices(ALPHABETS[name], k=length)) + " end")
        found += bool(spans)
        covered += sum(b - a for a, _, b in spans) / length
    assert found >= least * 1000 and covered >= (least - 0.03) * 1000


def test_share_of_names_taken_for_keys():
    rng = random.Random(2)
    plain, parted, joined, once = [p for p in PARTS if p.isalpha()], 0, 0, 0
    for _ in range(4000):
        parts = [rng.choice(PARTS) for _ in range(rng.randint(4, 10))]
        parted += bool(entropy_spans("".join(p + rng.choice("-_/") for p in parts)))
        joined += bool(entropy_spans("".join(p.capitalize() for p in parts)))
        name = [rng.choice(plain).capitalize() for _ in parts]
        name.insert(rng.randrange(len(name)), rng.choice(PARTS).capitalize())
        once += bool(entropy_spans("".join(name)))
    # of 4,000: 0.1 % of parted names, 1 % of joined ones with one number, and 20 % of joined ones with a number in every third part
    assert parted <= 4 and once <= 40 and joined <= 800


def test_counts_of_a_window_are_kept_up():
    rng = random.Random(3)
    s = "".join(rng.choices(string.ascii_letters + string.digits + "+/_=-", k=300))
    kind = {c: 0 for c in string.ascii_lowercase} | {c: 1 for c in string.ascii_uppercase} | {c: 2 for c in string.digits}
    window = Window(s)
    for end in range(1, len(s) + 1):
        full = window.step()
        part = [kind.get(c, 3) for c in s[max(0, end - WINDOW):end]]
        pairs = list(zip(part, part[1:], strict=False))
        assert full == (end >= WINDOW) and window.kinds == [part.count(k) for k in range(4)]
        assert window.changes == sum(x != y and 3 not in (x, y) for x, y in pairs)
        assert window.groups == sum(x != 2 and y == 2 for x, y in pairs) and window.calm == pairs.count((0, 0))
    assert set(LIMITS) == {"hex", "one_case", "mixed"}

"""Secret scan: fixed patterns plus a token-efficiency test.

A byte-pair vocabulary learned on text spends few characters per token on
random strings. Long runs of key-like characters below a limit of characters
per token are reported, unless they are known digests or identifiers.
"""

from __future__ import annotations

import base64
import re

import tiktoken
from pyspark.sql import DataFrame

from .common import map_lists, prepare, raw

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# The three base patterns, their least lengths and their order.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "random")
HINTS = ("passw", "secret", "token", "api")
# Fixed value: how the byte-level vocabulary's users split text before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Identifiers and digests that are random by nature and no secrets.
UUID = r"[0-9A-Fa-f]{8}-(?:[0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}"
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
# Where a run may be cut: a key can follow a path or a name, and can itself hold
# the last three separators.
CUTS = (re.compile(r"[^/=]+"), re.compile(r"[^/=+_-]+"))


def load_encoding(lines: list[bytes], pattern: str) -> tiktoken.Encoding:
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding("secret-scan", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


class Scanner:
    def __init__(self, encoding: tiktoken.Encoding, least: int = 20, ratio: float = 2.2):
        self.encoding, self.least, self.ratio = encoding, least, ratio
        # ASCII: neither the long s nor the Kelvin sign is a letter of a pattern.
        self.assign = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
        self.access = re.compile(ACCESS)
        self.hex = re.compile(r"[0-9a-f]{24,}")
        self.run = re.compile(rf"[A-Za-z0-9+/_=-]{{{least},}}")
        self.uuid = re.compile(UUID)

    def base(self, text: str) -> list[tuple[int, int, int]]:
        """(start, kind, end) of the base matches."""
        found = []
        lower = text.lower()
        if any(h in lower for h in HINTS):
            found += [(m.start(), 0, m.end()) for m in self.assign.finditer(text) if m.end(2) - m.start(2) >= 6]
        if "AKIA" in text:
            found += [(m.start(), 1, m.end()) for m in self.access.finditer(text) if m.end() - m.start() >= 20]
        found += [(m.start(), 2, m.end()) for m in self.hex.finditer(text)]
        return found

    def random(self, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Runs with few characters per token that no base match touches, known
        digests and identifiers left out. Of a run that is not reported as a
        whole, the pieces between separators are judged by themselves."""
        found = []
        for m in self.run.finditer(text):
            touching = [(start, end) for start, _, end in base if start < m.end() and m.start() < end]
            found += [(start, 3, end) for start, end in self.judge(text, m.start(), m.end(), touching)]
        return found

    def judge(self, text: str, start: int, end: int, touching: list[tuple[int, int]], cut: int = 0) -> list[tuple[int, int]]:
        """Spans of ``text[start:end]``: itself, or else those of its pieces."""
        run = text[start:end]
        if not any(map(str.isalpha, run)) or self.known(run):
            return []
        if not any(a < end and start < b for a, b in touching):
            if len(run) / len(self.encoding.encode_ordinary(run)) < self.ratio:
                return [(start, end)]
        if cut == len(CUTS):
            return []
        pieces = [(start + p.start(), start + p.end()) for p in CUTS[cut].finditer(run) if p.end() - p.start() >= self.least]
        return [s for a, b in pieces for s in self.judge(text, a, b, touching, cut + 1)]

    def known(self, run: str) -> bool:
        if self.uuid.fullmatch(run):
            return True
        core = run.split("=", 1)[-1] if run.startswith(("md5=", "sha1=", "sha256=")) else run
        return len(core) in DIGEST_LENGTHS and all(c in "0123456789abcdef" for c in core.lower())

    def scan(self, text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
        base = self.base(text)
        return sorted(base), sorted(base + self.random(text, base))


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan_secrets(
    docs: DataFrame, vocabulary: str = VOCABULARY, split: str = SPLIT, least: int = 20, ratio: float = 2.2
) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, n_random, base_spans, spans`` per row.

    A random span is a run of at least ``least`` key characters with a letter,
    or a piece of one between ``/=`` or ``/=+_-``, below ``ratio`` characters a
    token. UUIDs, digests and runs without letters are left out.

    Whole texts are scanned, long ones too; positions are code points, ends
    exclusive. A null text is an empty one without spans. Every input row, with
    null or repeated ids, gives one row; other columns are not read. An empty
    table gives an empty result.

    One pass without a shuffle. The vocabulary is a file of fixed size that the
    driver reads and broadcasts.
    """
    spark = prepare(docs.sparkSession)
    with open(vocabulary, "rb") as file:
        shared = spark.sparkContext.broadcast(file.read())

    def make():
        scanner = Scanner(load_encoding(shared.value.splitlines(), split), least, ratio)

        def step(ids, texts):
            rows = []
            for i, text in zip(ids, texts):
                base, spans = scanner.scan(text.decode("utf-8", "replace"))
                kinds = [k for _, k, _ in spans]
                rows.append((i, *(kinds.count(k) for k in range(4)), joined(base), joined(spans)))
            return list(map(list, zip(*rows))) if rows else [[]] * 7

        return step

    kind = dict(docs.dtypes)["doc_id"]
    return map_lists(
        docs.select("doc_id", raw("text").alias("text")),
        make,
        f"doc_id {kind}, n_assign long, n_access long, n_hex long, n_random long, base_spans string, spans string",
    )

"""Secret scans: fixed patterns, plus dictionary-primed zstandard novelty.

Every text is scanned whole by three fixed patterns.  Further candidates, words
of a secret's alphabet, are measured: the bytes that a candidate adds to the
compressed size of its surroundings, with a compressor that is primed by a
dictionary of common identifiers.  A candidate that hardly compresses and
stands in a sensitive context is reported as kind ``novel``.

One pass without a shuffle.  A null or empty text has no spans; very long texts
are scanned whole; repeated rows give repeated rows; only ``doc_id`` and
``text`` are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds in their order, with patterns and the least length of the group that counts.
PATTERNS = [
    ("assign", re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]{24,}"), 0, 24),
]
KINDS = [k for k, *_ in PATTERNS] + ["novel"]

#: Words that make a context sensitive.
SENSITIVE = re.compile(r"passw|passwd|pwd|secret|token|api[_-]?key|private[_-]?key|credential|auth|bearer|akia|access[_-]?key", re.IGNORECASE | re.ASCII)
#: Identifiers, settings and words that surround secrets in code and configuration; the likelier ones stand last, nearest to the text.
IDENTIFIERS = (
    "abstract async await boolean break byte case catch char continue default double else elif enum except extends final finally float foreach "
    "global goto implements import include instanceof int interface internal lambda long namespace native nonlocal object operator override package "
    "pass print private protected public raise require return short sizeof static string struct super switch synchronized template throw throws try "
    "typedef typename union unsigned using virtual void volatile while yield const let var function class module exports module.exports __init__ __main__ "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 0123456789abcdef 1234567890 00000000 11111111 ffffffff deadbeef xxxxxxxx XXXXXXXX "
    "2023-01-01T00:00:00Z application/json application/x-www-form-urlencoded text/html charset=utf-8 Content-Type User-Agent Accept-Encoding gzip deflate "
    "http:// https:// www. .com .org .net .io /index.html /api/v1/ /v2/ /usr/local/bin /etc/ /var/log/ /home/ node_modules package.json requirements.txt "
    "Dockerfile docker-compose.yml kubernetes deployment namespace metadata labels selector replicas container image latest service ingress configmap "
    "region us-east-1 us-west-2 eu-west-1 bucket queue topic cluster instance endpoint account tenant subscription project resource group "
    "mysql postgres postgresql mongodb redis sqlite jdbc odbc driver schema table column index select from where insert into values update delete "
    "BEGIN RSA PRIVATE KEY END RSA PRIVATE KEY BEGIN CERTIFICATE END CERTIFICATE ssh-rsa AAAAB3NzaC1yc2E sha256 sha512 md5 hmac base64 utf-8 encode decode "
    "getenv os.environ process.env System.getenv environment setting settings config configuration properties options parameters arguments kwargs "
    "user username user_name userId email mail login logout signin signup session cookie csrf nonce state redirect_uri callback scope grant_type "
    "client_id client_secret clientId clientSecret refresh_token access_token id_token oauth oauth2 jwt saml openid consumer_key consumer_secret "
    "database host hostname port localhost 127.0.0.1 0.0.0.0 connection connection_string dsn url uri path proxy timeout retry debug verbose "
    "changeme change_me placeholder your_password your_token your_api_key your-secret-key-here example sample dummy fake test testing none null true false "
    "authorization Authorization: Bearer Authorization: Basic x-api-key X-Auth-Token credential credentials private_key public_key secret_key access_key "
    "accessKeyId secretAccessKey api_key apikey apiKey API_KEY api_token auth_token secret token passwd pwd password = value name key: "
)
#: Candidates: runs of a secret's alphabet that hold a letter and a digit.
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[0-9+/_=-]*[A-Za-z])[A-Za-z0-9+/_=-]{12,}", re.ASCII)

SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_novel long, novelty double"


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, kind's number, end) of the fixed patterns' matches, in order."""
    found = []
    for k, (_, pattern, group, least) in enumerate(PATTERNS):
        found += [(m.start(), k, m.end()) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
    return sorted(found)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{start}:{end}" for start, k, end in spans)


class Novelty:
    """Marginal compressed bytes of a candidate against its surroundings and the identifier dictionary."""

    def __init__(self, identifiers: str = IDENTIFIERS, level: int = 3):
        primed = zstandard.ZstdCompressionDict(identifiers.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.compressor = zstandard.ZstdCompressor(level=level, dict_data=primed, write_content_size=False, write_checksum=False, write_dict_id=False)

    def bytes_per_char(self, before: str, candidate: str, after: str) -> float:
        around = (before + after).encode("utf-8", "replace")
        added = self.compressor.compress(around + candidate.encode()), self.compressor.compress(around)
        return (len(added[0]) - len(added[1])) / len(candidate)


def novel_spans(text: str, taken: list[tuple[int, int, int]], novelty: Novelty, window: int, least: float) -> tuple[list[tuple[int, int, int]], float]:
    """Candidates in sensitive contexts that no fixed pattern covers and that stay incompressible."""
    found, best, k = [], 0.0, 0
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        while k < len(taken) and taken[k][2] <= start:
            k += 1
        if any(t[0] < end and t[2] > start for t in taken[max(0, k - 3) : k + 3]):
            continue
        before, after = text[max(0, start - window) : start], text[end : end + window // 4]
        if not SENSITIVE.search(before[-(window // 4) :]):
            continue
        share = novelty.bytes_per_char(before, m.group(), after)
        best = max(best, share)
        if share >= least:
            found.append((start, 3, end))
    return found, best


def scan_secrets(documents: DataFrame, window: int = 256, least: float = 0.7) -> DataFrame:
    """Per row of ``documents``: counts and spans of secrets, as code points with exclusive ends.

    ``window``: characters before a candidate that its novelty is measured against, a quarter of it after;
    the nearest quarter before must name something sensitive.  ``least``: marginal bytes per character.
    """
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty()
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                rows = []
                for text in part.column(1).to_pylist():
                    text = text or ""
                    base = base_spans(text)
                    more, best = novel_spans(text, sorted(base, key=lambda s: s[2]), novelty, window, least)
                    counts = [sum(s[1] == k for s in base) for k in range(3)]
                    rows.append((*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(sorted(base + more)), len(more), best))
                names = ["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_novel", "novelty"]
                yield pa.RecordBatch.from_pydict({"doc_id": part.column(0)} | {n: list(c) for n, c in zip(names, zip(*rows, strict=True), strict=True)})

    return texts.mapInArrow(scan, SCHEMA)

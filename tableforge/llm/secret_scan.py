"""Secret scans by a trigram index.

Each rule's regular expression gives a Boolean query over trigrams that every match must hold (AND of sequences, OR of
branches). Each run of whole texts in an Arrow batch is an index segment: its trigrams are extracted in one pass, and those
that some query asks for get a posting list, the texts that hold them. A rule's query intersects and unites postings;
only the candidates left are searched by the regular expression. Rules without mandatory trigrams scan all texts.
Extraction costs the same however many rules there are.

Null text is empty text. Spans are in code points, end exclusive; per rule they are leftmost and don't overlap. Texts of
any length are scanned whole; all patterns take linear time. Repeated rows are scanned one by one; equal spans of several
kinds are all kept, in the rules' order. An empty table gives no rows. Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
import re
from re import _constants as K
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableforge.llm import common

#: A private key whole: up to its END line or, without one before the next marker, its headers and base64 runs (of 20 and
#: more, one shorter one behind each, and lines of their own), parted by blanks, quotes or escapes. Nothing is tried twice.
_KEY = r"(?:RSA |EC |DSA |OPENSSH |ENCRYPTED )?PRIVATE KEY-----"
_PART = r"""(?:[\s"'>#|,]|\\++[nrt]?+)"""
_RUN = r"[A-Za-z0-9+/=]"
_BODY = rf"(?:{_PART}*+[A-Za-z][A-Za-z-]*+:\x20*+[^\s\\]++)*+(?:{_PART}*+(?:{_RUN}{{20,}}+(?:{_PART}++{_RUN}{{1,19}}+(?!{_RUN}))?+|{_RUN}++(?=[\x20\t\r]*+(?:\n|\\[nr]|\Z))))*+"
_PEM = rf"-----BEGIN {_KEY}(?>(?:[^-]++|-(?!----))*+-----END {_KEY}|{_BODY})"

#: Kind, pattern, ignore case, group whose length counts, least length. The first three are the base; runs
#: of hex digits that are too short are left out by the pattern itself.
RULES = [
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", True, 2, 8),
    ("access", r"AKIA[A-Z0-9]+", False, 0, 16),
    ("hex", r"[0-9a-f]{32,}", False, 0, 32),
    ("github", r"gh[pousr]_[A-Za-z0-9]{36}", False, 0, 40),
    ("github_fine", r"github_pat_[A-Za-z0-9_]{60,}", False, 0, 71),
    ("gitlab", r"glpat-[A-Za-z0-9_-]{20,}", False, 0, 26),
    ("gitlab_runner", r"glrt-[A-Za-z0-9_-]{20,}", False, 0, 25),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", False, 0, 15),
    ("slack_app", r"xapp-[0-9]-[A-Za-z0-9-]{20,}", False, 0, 27),
    ("slack_hook", r"hooks\.slack\.com/services/T[A-Za-z0-9]{6,12}/B[A-Za-z0-9]{6,12}/[A-Za-z0-9]{20,}", False, 0, 60),
    ("google", r"AIza[A-Za-z0-9_-]{35}", False, 0, 39),
    ("google_client", r"(?<![0-9])[0-9]{6,20}-[a-z0-9]{32}\.apps\.googleusercontent\.com", False, 0, 60),
    ("google_secret", r"GOCSPX-[A-Za-z0-9_-]{28}", False, 0, 35),
    ("google_access", r"ya29\.[A-Za-z0-9_-]{20,}", False, 0, 25),
    ("firebase", r"AAAA[A-Za-z0-9_-]{7}:APA91b[A-Za-z0-9_-]{100,}", False, 0, 118),
    ("stripe", r"[sr]k_(?:live|test)_[A-Za-z0-9]{16,}", False, 0, 24),
    ("stripe_hook", r"whsec_[A-Za-z0-9]{32,}", False, 0, 38),
    ("aws_secret", r"""aws_secret(?:_access)?_key["']?\x20*[:=]\x20*["']?[A-Za-z0-9/+]{40}""", True, 0, 55),
    ("aws_session", r"ASIA[A-Z0-9]{16}", False, 0, 20),
    ("aws_mws", r"amzn\.mws\.[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}", False, 0, 45),
    ("azure_storage", r"AccountKey=[A-Za-z0-9+/]{86}==", False, 0, 99),
    ("azure_signature", r"[?&]sig=[A-Za-z0-9%]{43,}", False, 0, 48),
    ("sendgrid", r"SG\.[A-Za-z0-9_-]{22}\.[A-Za-z0-9_-]{43}", False, 0, 69),
    ("mailgun", r"key-[0-9a-f]{32}", False, 0, 36),
    ("mailchimp", r"[0-9a-f]{32}-us[0-9]{1,2}", False, 0, 36),
    ("npm", r"npm_[A-Za-z0-9]{36}", False, 0, 40),
    ("pypi", r"pypi-AgEIcHlwaS5vcmc[A-Za-z0-9_-]{50,}", False, 0, 70),
    ("rubygems", r"rubygems_[0-9a-f]{48}", False, 0, 57),
    ("docker", r"dckr_pat_[A-Za-z0-9_-]{27,}", False, 0, 36),
    ("digitalocean", r"do[opr]_v1_[0-9a-f]{64}", False, 0, 71),
    ("shopify", r"shp(?:at|ca|pa|ss)_[0-9a-fA-F]{32}", False, 0, 38),
    ("square", r"sq0(?:atp|csp)-[A-Za-z0-9_-]{22,43}", False, 0, 29),
    ("hub_model", r"hf_[A-Za-z0-9]{34}", False, 0, 37),
    ("model_key", r"sk-(?:proj-)?[A-Za-z0-9]{40,}", False, 0, 43),
    ("databricks", r"dapi[0-9a-f]{32}", False, 0, 36),
    ("atlassian", r"ATATT3[A-Za-z0-9_=-]{60,}", False, 0, 66),
    ("linear", r"lin_api_[A-Za-z0-9]{40}", False, 0, 48),
    ("notion", r"ntn_[A-Za-z0-9]{40,}", False, 0, 44),
    ("postman", r"PMAK-[0-9a-f]{24}-[0-9a-f]{34}", False, 0, 64),
    ("telegram", r"(?<![0-9])[0-9]{8,10}:AA[A-Za-z0-9_-]{33}", False, 0, 44),
    ("discord_hook", r"discord(?:app)?\.com/api/webhooks/[0-9]{16,20}/[A-Za-z0-9_-]{60,}", False, 0, 90),
    ("terraform", r"[A-Za-z0-9]{14}\.atlasv1\.[A-Za-z0-9_=-]{60,}", False, 0, 83),
    ("vault", r"hv[sb]\.[A-Za-z0-9_-]{24,}", False, 0, 28),
    ("grafana", r"glsa_[A-Za-z0-9]{32}_[0-9a-f]{8}", False, 0, 46),
    ("newrelic", r"NRAK-[A-Z0-9]{27}", False, 0, 32),
    ("pulumi", r"pul-[0-9a-f]{40}", False, 0, 44),
    ("artifactory", r"AKCp[A-Za-z0-9]{69,}", False, 0, 73),
    ("planetscale", r"pscale_(?:tkn|pw)_[A-Za-z0-9_.=-]{32,}", False, 0, 42),
    ("doppler", r"dp\.pt\.[A-Za-z0-9]{43}", False, 0, 49),
    ("sentry", r"sntry[su]_[A-Za-z0-9_=+/-]{40,}", False, 0, 47),
    ("figma", r"figd_[A-Za-z0-9_-]{40}", False, 0, 45),
    ("airtable", r"pat[A-Za-z0-9]{14}\.[0-9a-f]{64}", False, 0, 82),
    ("dropbox", r"(?<![A-Za-z0-9])sl\.[A-Za-z0-9_-]{130,}", False, 0, 133),
    ("age", r"AGE-SECRET-KEY-1[A-Z0-9]{58}", False, 0, 74),
    ("putty", r"PuTTY-User-Key-File-[23]:", False, 0, 22),
    ("bearer", r"bearer\x20+[A-Za-z0-9._~+/-]{20,}=*", True, 0, 27),
    ("basic", r"authorization:\x20*basic\x20+[A-Za-z0-9+/]{12,}=*", True, 0, 32),
    ("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", False, 0, 24),
    ("pem", _PEM, False, 0, 27),
    ("url", r"[a-z][a-z0-9+]{0,31}://[^\s:/@]+:[^\s:/@]+@", True, 0, 8),
]
BASE = ("assign", "access", "hex")


def exact_strings(items, most: int = 64) -> list[list[str]]:
    """The mandatory parts of a parsed pattern, in order: each a list of the strings that may stand there."""
    parts: list[list[str]] = []
    run = [""]

    def flush(start: tuple[str, ...] = ("",)) -> None:
        nonlocal run
        parts.append(run)
        run = list(start)

    for op, value in items:
        choices: list[str] | None = None
        if op is K.LITERAL:
            choices = [chr(value)]
        elif op is K.IN and all(o is K.LITERAL for o, _ in value):
            choices = [chr(v) for _, v in value]
        elif op is K.SUBPATTERN or op is K.BRANCH:
            branches = value[1] if op is K.BRANCH else [value[3]]
            inner = [exact_strings(b) for b in branches]
            choices = [s for x in inner for s in x[0]] if all(len(x) == 1 for x in inner) else None
            if choices is None and op is K.SUBPATTERN:
                flush()
                parts += inner[0]
                continue
        elif op is K.MAX_REPEAT and value[0] == 0 and value[1] == 1:
            inner = exact_strings(value[2])
            choices = ["", *inner[0]] if len(inner) == 1 else None
        elif op is K.MAX_REPEAT and value[0] >= 1:
            inner = exact_strings(value[2])
            flush()
            parts += inner
            continue
        if choices is None or len(run) * len(choices) > most:
            flush()
        else:
            run = [r + c for r in run for c in choices]
    flush()
    return [p for p in parts if p != [""]] or [[""]]


def trigram_query(pattern: str) -> list[list[list[str]]] | None:
    """AND of ORs of ANDs of lower-case trigrams that every match holds; None if there are none."""
    query = []
    for strings in exact_strings(_parser.parse(pattern)):
        grams = [sorted({s.lower()[i : i + 3] for i in range(len(s) - 2)}) for s in strings]
        if all(grams):
            query.append(grams)
    return query or None


QUERIES = [trigram_query(p) for _, p, *_ in RULES]
PATTERNS = [re.compile(p, re.ASCII | (re.IGNORECASE if fold else 0)) for _, p, fold, _, _ in RULES]
TRIGRAMS = sorted({g for q in QUERIES if q for branch in q for grams in branch for g in grams})
_SLOT = {g: k for k, g in enumerate(TRIGRAMS)}
_CODES = np.array([int.from_bytes(g.encode(), "big") for g in TRIGRAMS])  # ascending, as the trigrams are
_PAIRS = np.zeros(1 << 16, bool)
_PAIRS[_CODES >> 8] = True


def postings(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The index of a segment: [trigram, text] is true where the text holds the trigram, A-Z in lower case. Every place
    of the segment is looked at once, a bounded part of it at a time."""
    held = np.zeros((len(TRIGRAMS), len(offsets) - 1), bool)
    for lo in range(0, max(0, len(data) - 2), common.BLOCK_BYTES):
        part = common.LOWER[data[lo : lo + common.BLOCK_BYTES + 2]].astype(np.uint16)
        at = np.flatnonzero(_PAIRS[part[:-2] << 8 | part[1:-1]])  # the first two bytes rule out most places
        code = part[at].astype(np.int64) << 16 | part[at + 1].astype(np.int64) << 8 | part[at + 2]
        slot = np.minimum(np.searchsorted(_CODES, code), len(_CODES) - 1)
        row = np.searchsorted(offsets, at + lo, side="right") - 1
        hit = (_CODES[slot] == code) & (at + lo + 3 <= offsets[row + 1])
        held[slot[hit], row[hit]] = True
    return held


def candidates(query: list[list[list[str]]] | None, index: np.ndarray) -> np.ndarray:
    """The texts of a segment that may hold a match: postings intersected and united as the query says."""
    found = np.ones(index.shape[1], bool)
    for branches in query or ():
        either = np.zeros_like(found)
        for grams in branches:
            either |= index[[_SLOT[g] for g in grams]].all(0)
        found &= either
    return np.flatnonzero(found)


def spans_of(column: pa.Array) -> list[list[tuple[int, int, int]]]:
    """(start, rule, end) of each text, in order."""
    out: list[list[tuple[int, int, int]]] = []
    for lo, hi, data, offsets in common.blocks(column):
        texts, index = column.slice(lo, hi - lo).fill_null("").to_pylist(), postings(data, offsets)
        own: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for k, (query, pattern, (_, _, _, group, least)) in enumerate(zip(QUERIES, PATTERNS, RULES, strict=True)):
            for i in candidates(query, index).tolist():
                own[i] += [(m.start(), k, m.end()) for m in pattern.finditer(texts[i]) if m.end(group) - m.start(group) >= least]
        out += map(sorted, own)
    return out


RESULT = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def scanner(id_col: str = "doc_id", redact: bool = False):
    """The step over Arrow batches (id, text) that ``secret_scan`` takes."""
    names = [id_col, "n_assign", "n_access", "n_hex", "base_sha256", "spans", *["redacted"] * redact]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = spans_of(batch.column(1))
        say = lambda some: ",".join(f"{RULES[k][0]}:{a}:{b}" for a, k, b in some)
        base = [[x for x in s if RULES[x[1]][0] in BASE] for s in found]
        columns = [batch.column(0)]
        columns += [pa.array([sum(RULES[x[1]][0] == kind for x in s) for s in base], pa.int64()) for kind in BASE]
        columns += [pa.array([hashlib.sha256(say(s).encode()).hexdigest() for s in base]), pa.array([say(s) for s in found], pa.string())]
        if redact:
            columns.append(pa.array([redacted(t, s) if s else t for t, s in zip(batch.column(1).to_pylist(), found, strict=True)], pa.string()))
        return pa.RecordBatch.from_arrays(columns, names)

    return run


def secret_scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, counts of the base kinds, base_sha256 and spans of every document."""
    return common.map_arrow(df.select(id_col, text_col), scanner(id_col), f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, {RESULT}")


def without_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with every span in their texts starred out (lengths stay)."""
    prefix = common.unused(docs, "_secret_")
    made = common.annotated(docs, [id_col, text_col], scanner(redact=True), f"{RESULT}, redacted string", prefix)
    return made.withColumn(text_col, F.col(f"{prefix}redacted")).select(docs.columns)


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    out, at = [], 0
    for a, _, b in spans:
        if b > at:
            out += [text[at : max(a, at)], "*" * (b - max(a, at))]
            at = b
    return "".join([*out, text[at:]])


def op3_secret_scan(spark, sf_dir: str) -> DataFrame:
    return secret_scan(common.documents(spark, sf_dir))

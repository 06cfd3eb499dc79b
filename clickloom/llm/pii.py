"""Personal data by weak supervision: labelers vote on candidate spans, EM weighs them, a classifier decides.

One pass over the texts finds the base spans (four strict patterns) and looser candidates: numbers with separators, written
out addresses, names. A candidate is described by its kind and twelve yes/no facts, so the whole corpus is summed up
exactly in at most ``len(KINDS) * 2**12`` counts, whatever its size. Labelers (strict and negative patterns, checks,
gazetteers, context words, placeholders) turn facts into votes; expectation-maximisation over the counts estimates how
reliable each is and how likely each candidate is personal; a logistic classifier on the facts learns these beliefs.
Candidates it accepts are added unless they overlap a base span or an earlier addition.

Defined results: a null text is an empty one and has no spans; positions are code points, ends exclusive; repeated rows
count as often as they occur; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clickloom.llm.base import text_of
from clickloom.session import materialize

BASE = ["email", "ip", "card", "phone"]
KINDS = [*BASE, "id", "name"]
FACTS = ["strict", "valid", "known", "person", "context", "counter", "date", "amount", "placeholder", "embedded", "grouped", "marked"]

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

MARK = re.compile(r" ?(?:@|\(at\)|\[at\]|\{at\}) ?")
LOOSE_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?: ?(?:\.|\(dot\)|\[dot\]|\{dot\}) ?[A-Za-z0-9-]+)+")
NUMBER = re.compile(r"(?<![0-9])(?:\+|\()?[0-9](?:[\x20()./-]{0,2}[0-9]){6,}")
SOCIAL = re.compile(r"(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}")
DATE = re.compile(r"(?:19|20)[0-9]{2}[-/. ][01]?[0-9][-/. ][0-3]?[0-9]|[0-3]?[0-9][-/.][0-3]?[0-9][-/.](?:19|20)[0-9]{2}")
AMOUNT = re.compile(r"[0-9]{1,3}(?:[. ][0-9]{3})+|[0-9]+\.[0-9]+|[0-9]{4}[ -]+[0-9]{4}")
SURNAME = re.compile(r"\.? ([A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ'-]{1,30})(?: ([A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ'-]{1,30}))?")

ENDINGS = {"com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu", "at", "ch", "it", "nl"}
TITLES = ["Mr", "Mrs", "Ms", "Dr", "Prof", "Herr", "Frau", "Mme", "Monsieur", "Madame", "Señor", "Señora", "Sra"]
GIVEN = ["James", "John", "Robert", "Michael", "William", "David", "Richard", "Thomas", "Mary", "Patricia", "Jennifer", "Linda",
         "Elizabeth", "Susan", "Sarah", "Karen", "Peter", "Hans", "Klaus", "Jürgen", "Ursula", "Monika", "Petra", "Sabine",
         "Jean", "Pierre", "Michel", "Philippe", "Marie", "Nathalie", "Isabelle", "Sylvie", "José", "Juan", "Antonio", "Carlos",
         "María", "Carmen", "Ana", "Isabel"]
FOR = {
    "email": "mail email e-mail contact write courriel correo kontakt".split(),
    "ip": "ip address host server adresse dirección".split(),
    "card": "card visa mastercard amex credit karte carte tarjeta kredit".split(),
    "phone": "phone tel call fax mobile telefon téléphone teléfono handy móvil".split(),
    "id": "ssn social security id passport ausweis sécurité dni".split(),
    "name": "name from by signed contact author von par por".split(),
}
AGAINST = "isbn issn version page order invoice price total chapter seite preis prix precio § $ € % no nr".split()
LETTER = re.compile(r"[^\W_]+|[§$€%]")


def luhn(digits: str) -> bool:
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (doubled + sum(map(int, digits[::-2]))) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost, non-overlapping, in linear time: the part before an @ is what precedes it of allowed characters."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = floor + len(text[floor:at].rstrip(LOCAL))
        after = DOMAIN.match(text, at + 1) if start < at else None
        if after:
            yield start, after.end()
        floor = after.end() if after else at + 1
        at = text.find("@", floor)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) by kind, then start."""
    found = [(0, s, e) for s, e in emails(text)]
    found += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p) < 256 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append((2, m.start(), m.end()))
    if "+" in text:
        found += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return found


@lru_cache(maxsize=1)
def gazetteer():
    import ahocorasick
    words = ahocorasick.Automaton()
    for word in TITLES:
        words.add_word(word, (len(word), True))
    for word in GIVEN:
        words.add_word(word, (len(word), False))
    words.make_automaton()
    return words


def shaped(text: str) -> Iterator[tuple[str, int, int, set[str]]]:
    """Looser candidates with the facts that their shape tells."""
    floor = 0
    for mark in MARK.finditer(text):
        if mark.start() < floor:
            continue
        start = floor + len(text[floor:mark.start()].rstrip(LOCAL))
        after = LOOSE_DOMAIN.match(text, mark.end()) if start < mark.start() else None
        if after:
            ending = re.split(r"[^A-Za-z0-9-]+", after[0])[-1].lower()
            plain = mark[0] == "@" and DOMAIN.fullmatch(after[0])
            facts = {"strict"} if plain else {"marked"} if mark[0].strip() != "@" else set()
            yield "email", start, after.end(), facts | ({"valid"} if ending in ENDINGS else set())
        floor = after.end() if after else mark.end()
    for m in NUMBER.finditer(text):
        shown = m[0]
        digits = re.sub("[^0-9]", "", shown)
        dotted = shown.split(".")
        facts = set()
        if len(dotted) == 4 and all(p.isdigit() for p in dotted):
            kind = "ip"
            facts |= {"strict", "valid"} if all(len(p.lstrip("0")) < 4 and int(p) < 256 for p in dotted) else set()
            facts |= {"known"} if dotted[0] in ("10", "127", "172", "192") else set()
        elif 16 <= len(digits) <= 19:
            kind = "card"
            facts |= {"strict", "valid"} if CARD.fullmatch(shown) and luhn(digits) else {"valid"} if luhn(digits) else set()
            facts |= {"known"} if digits[0] in "3456" else set()
        elif re.fullmatch("[0-9]{3}-[0-9]{2}-[0-9]{4}", shown):
            kind = "id"
            facts |= {"valid"} if SOCIAL.fullmatch(shown) else set()
        elif 7 <= len(digits) <= 15:
            kind = "phone"
            facts |= {"strict"} if PHONE.fullmatch(shown) and len(digits) >= 8 else set()
            facts |= {"valid"} if 8 <= len(digits) and (shown[0] in "+(" or digits[0] == "0") else set()
            facts |= {"known"} if shown[0] == "+" or shown.startswith("00") else set()
        else:
            continue
        facts |= {"date"} if DATE.fullmatch(shown) else set()
        facts |= {"amount"} if AMOUNT.fullmatch(shown) else set()
        facts |= {"placeholder"} if len(set(digits)) < 3 or digits in "01234567890123456789" else set()
        facts |= {"grouped"} if len(re.split("[^0-9]+", shown.strip("+()"))) > 2 else set()
        yield kind, m.start(), m.end(), facts
    floor = 0
    for last, (length, title) in gazetteer().iter(text):
        start = last + 1 - length
        if start < floor or (start and text[start - 1].isalnum()):
            continue
        after = SURNAME.match(text, last + 1)
        if after and (title or text[last + 1] == " "):
            floor = after.end(1) if not (title and after[2]) else after.end()
            yield "name", start, floor, {"known"} | ({"valid"} if title else set()) | ({"person"} if not title or after[1] in GIVEN else set())


def candidates(text: str) -> list[tuple[int, int, int, int]]:
    """(kind number, start, end, facts as bits)."""
    found = []
    for kind, start, end, facts in shaped(text):
        before = {w.lower() for w in LETTER.findall(text[max(0, start - 40):start])}
        facts |= {"context"} if before & set(FOR[kind]) else set()
        facts |= {"counter"} if before & set(AGAINST) else set()
        facts |= {"embedded"} if (start and (text[start - 1].isalnum() or text[start - 1] in "_=/")) or text[end:end + 1].isalnum() else set()
        if kind != "name" and any(g in text[max(0, start - 40):start] for g in GIVEN):
            facts.add("person")
        found.append((KINDS.index(kind), start, end, sum(1 << FACTS.index(f) for f in facts)))
    return found


def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.list_(pa.int32()))
    for batch in batches:
        for at in range(0, len(batch), 1024):
            part = batch.slice(at, 1024)
            texts = part.column(1).to_pylist()
            yield pa.record_batch([
                part.column(0), pa.array([base_spans(t) for t in texts], span), pa.array([candidates(t) for t in texts], span),
            ], names=["doc_id", "base", "loose"])


def votes(kinds: np.ndarray, facts: np.ndarray) -> np.ndarray:
    """Votes of the labelers, in -1, 0 (abstains) and 1, for rows of facts."""
    f = {name: facts[:, k].astype(bool) for k, name in enumerate(FACTS)}
    vote = lambda plus, minus: np.where(plus, 1, np.where(minus, -1, 0))
    no = np.zeros(len(facts), bool)
    return np.stack([
        vote(f["strict"], no),                              # strict pattern
        vote(no, f["date"] | f["amount"]),                  # patterns of other things
        vote(f["valid"], ~f["valid"]),                      # check sums and ranges
        vote(f["known"], no),                               # gazetteers of prefixes and titles
        vote(f["person"], no),                              # gazetteer of given names
        vote(f["context"], f["counter"] & ~f["context"]),   # context words
        vote(f["marked"] | f["grouped"], no),               # written the way people write it
        vote(no, f["placeholder"] | f["embedded"]),         # part of something else
    ], axis=1)


def expectation_maximisation(kinds: np.ndarray, cast: np.ndarray, counts: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Belief that a row is personal, from votes whose reliabilities are estimated along."""
    belief = 1 / (1 + np.exp(-cast.sum(axis=1).astype(float)))
    for _ in range(rounds):
        log_odds = np.zeros(len(counts))
        for kind in range(len(KINDS)):
            own = kinds == kind
            yes, both = (counts * belief)[own].sum() + 1, counts[own].sum() + 2
            log_odds[own] = np.log(yes) - np.log(both - yes)
        for k in range(cast.shape[1]):
            for v in (-1, 0, 1):
                is_v = cast[:, k] == v
                yes = ((counts * belief)[is_v].sum() + 1) / ((counts * belief).sum() + 3)
                no = ((counts * (1 - belief))[is_v].sum() + 1) / ((counts * (1 - belief)).sum() + 3)
                log_odds[is_v] += np.log(yes) - np.log(no)
        belief = 1 / (1 + np.exp(-np.clip(log_odds, -30, 30)))
    strict = cast[:, 0] == 1
    if strict.any() and (counts * belief)[strict].sum() < 0.5 * counts[strict].sum():
        belief = 1 - belief      # the two classes have changed names
    return belief


def fit(patterns: np.ndarray, counts: np.ndarray, ridge: float = 1.0) -> set[int]:
    """The (kind, facts) patterns that the trained classifier takes for personal data."""
    if not len(patterns):
        return set()
    kinds = patterns >> len(FACTS)
    facts = (patterns[:, None] >> np.arange(len(FACTS))) & 1
    belief = expectation_maximisation(kinds, votes(kinds, facts), counts.astype(float))
    own = np.eye(len(KINDS))[kinds]
    x = np.concatenate([own, facts, own * facts[:, [FACTS.index("valid")]], own * facts[:, [FACTS.index("context")]]], axis=1)
    # Frequent patterns weigh by the logarithm of their count, so that a few of them do not decide alone.
    weight, beta = np.log1p(counts), np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (belief - p)) - ridge * beta
        curve = (x.T * (weight * p * (1 - p))) @ x + ridge * np.eye(len(beta))
        beta += np.linalg.solve(curve, slope)
    return set(patterns[x @ beta > 0].tolist())


def resolve(accepted: frozenset[int]):
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        join = lambda spans: ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)
        for batch in batches:
            rows = []
            for doc_id, base, loose in zip(*(batch.column(k).to_pylist() for k in range(3))):
                base = [tuple(x) for x in base]
                taken, added = sorted((s, e) for _, s, e in base), []
                starts = np.array([s for s, _ in taken])
                reach = np.maximum.accumulate([e for _, e in taken]) if taken else starts
                end = -1
                for kind, start, stop, facts in sorted(loose, key=lambda x: (x[1], -x[2], x[0])):
                    before = int(np.searchsorted(starts, stop))     # base spans that begin before it ends
                    if start >= end and (kind << len(FACTS) | facts) in accepted and not (before and reach[before - 1] > start):
                        added.append((kind, start, stop))
                        end = stop
                rows.append({
                    "doc_id": doc_id, **{f"n_{kind}": sum(k == n for k, _, _ in base) for n, kind in enumerate(BASE)},
                    "base_sha256": hashlib.sha256(join(base).encode()).hexdigest(),
                    "spans": join(sorted({*base, *added})), "n_added": len(added),
                })
            yield pa.RecordBatch.from_pylist(rows, pa.schema([
                ("doc_id", pa.int64()), *[(f"n_{kind}", pa.int64()) for kind in BASE], ("base_sha256", pa.string()),
                ("spans", pa.string()), ("n_added", pa.int64()),
            ]))

    return digest


def personal_data(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, base counts by kind, sha256 of the base spans, and all spans as kind:start:end."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    spans = materialize(rows.mapInArrow(scan, "doc_id bigint, base array<array<int>>, loose array<array<int>>"), "spans")
    pattern = F.shiftleft(F.get("x", 0), len(FACTS)).bitwiseOR(F.get("x", 3))
    seen = spans.select(F.explode("loose").alias("x")).groupBy(pattern.alias("pattern")).count().orderBy("pattern")
    found = seen.collect()      # at most len(KINDS) * 2**len(FACTS) rows
    accepted = fit(np.array([r["pattern"] for r in found], np.int64), np.array([r["count"] for r in found], np.int64))
    columns = ", ".join(f"n_{kind} bigint" for kind in BASE)
    return spans.mapInArrow(resolve(frozenset(accepted)), f"doc_id bigint, {columns}, base_sha256 string, spans string, n_added bigint")

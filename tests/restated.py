"""The row semantics once more in plain Python, as a check on the Spark plans."""

from __future__ import annotations

from collections import Counter
from hashlib import sha1
from itertools import groupby


def squeeze(text):
    return " ".join(text.split())


def longest_run(text):
    return max((sum(1 for _ in same) for _, same in groupby(text)), default=0)


def top_share(text):
    words = text.split()
    return Counter(words).most_common(1)[0][1] / len(words) if words else 1.0


def reason(question, response, rules):
    q, r = squeeze(question or ""), squeeze(response or "")
    if "" in (q, r):
        return "empty"
    q_fits = rules.min_question_chars <= len(q) <= rules.max_question_chars
    r_fits = rules.min_response_chars <= len(r) <= rules.max_response_chars
    if not (q_fits and r_fits):
        return "length"
    limit = rules.drop_if_char_run_ge
    if limit > 1 and max(longest_run(q), longest_run(r)) >= limit:
        return "char_run"
    if len(r.split()) >= rules.rep_ratio_min_tokens and top_share(r) >= rules.drop_if_rep_ratio_ge:
        return "repetition"
    return "valid"


def key(question, response):
    return sha1(f"{squeeze(question).lower()}\n{squeeze(response).lower()}".encode()).digest()


def score(seed, content_key):
    digest = sha1(seed.to_bytes(8, "big") + content_key).digest()
    return int.from_bytes(digest, "big") / float(2**160)


def prepare(rows, rules, probability, seed, dedup):
    """Records of rows ``(seq, question, response, system_prompt, id)`` by ``seq``."""
    seen, records = set(), []
    for seq, question, response, system, row_id in sorted(rows):
        if reason(question, response, rules) != "valid":
            continue
        content = key(question, response)
        if score(seed, content) >= probability or (dedup and content in seen):
            continue
        seen.add(content)
        records.append(
            (seq, squeeze(question), "", squeeze(response), squeeze(str(system)), [], str(row_id))
        )
    return records

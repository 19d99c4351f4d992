"""Text-search predicates built from Spark's own string and array expressions.

A token is a run of letters, digits and underscores; a dot or apostrophe between two such runs stays inside the token,
so an IP address is one token while its port is another. Matching ignores case. Every predicate on tokens first asks a
cheap question about substrings and looks at tokens only in rows that pass it.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

_WORD = r"[\p{L}\p{N}_]"
TOKEN_PATTERN = rf"{_WORD}+(?:[.']{_WORD}+)*"
# A token starts / ends here: no token character, and no dot or apostrophe that joins to one.
_START = rf"(?<!{_WORD})(?<!{_WORD}[.'])"
_END = rf"(?!{_WORD})(?![.']{_WORD})"


def terms_of(query: str) -> list[str]:
    """The tokens of a search string, by the same rule as :func:`tokens`."""
    return re.findall(r"\w+(?:[.']\w+)*", query.lower())


def tokens(column: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(column), F.lit(TOKEN_PATTERN), F.lit(0))


def combined(columns: list[str]) -> Column:
    """Several text columns as one searchable text; a NULL column counts as empty."""
    if len(columns) == 1:
        return F.lower(F.coalesce(F.col(columns[0]), F.lit("")))
    return F.lower(F.concat_ws(" ", *columns))


def _literal(term: str) -> str:
    return re.escape(term)


def has_all_terms(columns: list[str], query: str) -> Column:
    """Every term occurs as a whole token in some column."""
    terms = list(dict.fromkeys(terms_of(query)))
    if not terms:
        return F.lit(False)
    body = combined(columns)
    cheap = [body.contains(t) for t in terms]
    exact = [body.rlike(f"{_START}{_literal(t)}{_END}") for t in terms]
    return reduce(and_, cheap + exact)


def has_prefix_terms(column: str, query: str) -> Column:
    """Search-as-you-type: any leading term as a token, or the last term as the start of a token."""
    terms = terms_of(query)
    if not terms:
        return F.lit(False)
    body = combined([column])
    options = [f"{_literal(t)}{_END}" for t in terms[:-1]] + [_literal(terms[-1])]
    return reduce(or_, [body.contains(t) for t in terms]) & body.rlike(f"{_START}(?:{'|'.join(options)})")


def starts_with_text(column: str, query: str) -> Column:
    """The whole text starts with the query, ignoring case; no character has a special meaning."""
    return F.lower(column).startswith(F.lower(F.lit(query)))


def allowed_edits(term: str) -> int:
    """Automatic edit distance by term length."""
    return 0 if len(term) <= 2 else 1 if len(term) <= 5 else 2


def _swap_matches(token: Column, term: str, edits: int) -> list[Column]:
    """Matches that use at least one swap of neighbours, which counts as one edit.

    One swap leaves ``edits - 1`` edits for the text before or after the swapped pair, never inside it.
    """
    out: list[Column] = []
    for i in range(1, len(term) - 1):
        if term[i] == term[i + 1]:
            continue
        head, pair, tail = term[:i], term[i + 1] + term[i], term[i + 2:]
        if edits == 1:
            out.append(token == head + pair + tail)
            continue
        rest = token.substr(F.lit(i + 3), F.length(token))
        before = F.left(token, F.length(token) - len(pair + tail))
        out.append(token.startswith(head + pair) & F.levenshtein(rest, F.lit(tail), 1).between(0, 1))
        out.append(token.endswith(pair + tail) & F.levenshtein(before, F.lit(head), 1).between(0, 1))
        for j in range(i + 2, len(term) - 1):
            if term[j] != term[j + 1]:
                out.append(token == head + pair + term[i + 2:j] + term[j + 1] + term[j] + term[j + 2:])
    return out


def _fuzzy_token(token: Column, term: str) -> Column:
    edits = allowed_edits(term)
    if edits == 0:
        return token == term
    close = F.length(token).between(len(term) - edits, len(term) + edits) & token.startswith(term[0])
    plain = F.levenshtein(token, F.lit(term), edits).between(0, edits)
    return close & reduce(or_, [plain, *_swap_matches(token, term, edits)])


def has_fuzzy_term(column: str, query: str) -> Column:
    """Some token is within the automatic edit distance of some term; the first character must agree."""
    terms = list(dict.fromkeys(terms_of(query)))
    if not terms:
        return F.lit(False)
    # A close token shares a piece of its term: of pieces cut two more than the edits allow, one stays whole (a swap can
    # harm two neighbouring pieces, and counts as one edit).
    body = F.lower(column)
    cheap = reduce(or_, [reduce(or_, [body.contains(piece) for piece in _pieces(q)]) for q in terms])
    return cheap & F.exists(_tokens_from(column, {t[0] for t in terms}), lambda t: reduce(or_, [_fuzzy_token(t, q) for q in terms]))


def _pieces(term: str) -> list[str]:
    """Pieces of the term of which at least one is left in every token within its edits; its first letter if too short."""
    parts = 2 * allowed_edits(term) + 1
    if len(term) < parts:
        return [term[0]]
    cuts = [len(term) * i // parts for i in range(parts + 1)]
    return [term[a:b] for a, b in zip(cuts, cuts[1:])]


def _tokens_from(column: str, first: set[str]) -> Column:
    """Only the tokens that begin with one of the characters; the character is tested before its surroundings."""
    head = f"[{re.escape(''.join(sorted(first)))}]"
    pattern = rf"{head}(?<!{_WORD}.)(?<!{_WORD}[.'].){_WORD}*(?:[.']{_WORD}+)*"
    return F.regexp_extract_all(F.lower(column), F.lit(pattern), F.lit(0))


def trigrams(column: Column) -> Column:
    """Distinct three-character pieces of each word, padded with two blanks before and one after."""
    words = F.regexp_extract_all(column, F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    pieces = F.transform(words, lambda w: F.transform(
        F.sequence(F.lit(1), F.length(w) + 1),
        lambda i: F.substring(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3)),
    ))
    return F.array_distinct(F.flatten(pieces))


def query_trigrams(query: str) -> list[str]:
    padded = [f"  {w} " for w in re.findall(r"[^\W_]+", query.lower())]
    return sorted({p[i:i + 3] for p in padded for i in range(len(p) - 2)})


def shared_trigrams(own: Column, query: str) -> Column:
    """Shared over all distinct trigrams of a text (``own``, from :func:`trigrams`) and the query, from 0 to 1."""
    wanted = query_trigrams(query)
    shared = F.size(F.array_intersect(own, F.array(*[F.lit(t) for t in wanted])))
    return shared / (F.size(own) + F.lit(len(wanted)) - shared)


def trigram_similarity(column: str, query: str) -> Column:
    """Trigram similarity of a text column and a query."""
    return shared_trigrams(trigrams(F.lower(column)), query)


def may_share_trigram(column: str, query: str) -> Column:
    """False only where no trigram of the query can occur: none of its blank-free parts is in the text."""
    parts = sorted({t.strip() for t in query_trigrams(query)})
    body = F.lower(column)
    return reduce(or_, [body.contains(p) for p in parts]) if parts else F.lit(False)


def prefix_term(query: str) -> str:
    """What a user has typed so far: of three or more words all, the last one down to three letters; else the first word.

    A last word of one or two letters cannot be shortened and also leaves the first word; a blank query stays as it is.
    """
    typed = re.match(r"\s*(\S+(?:\s+\S+)+\s+\S{3})\S*\s*$", query) or re.search(r"(\S+)", query)
    return re.sub(r"\s+", " ", typed[1]) if typed else query


def fuzzy_term(query: str) -> str:
    """The query with a typing error: its last letter is missing, unless that is a whole word."""
    tidy = " ".join(query.split())
    return re.sub(r"(?<=\S)\S$", "", tidy) if tidy else query

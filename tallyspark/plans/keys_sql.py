"""The client key of functions.canon said in SQL, for the comparison: patterns instead of words."""

from __future__ import annotations

from tallyspark.functions.canon import EXCLUDED_KEYS, LEGAL_SUFFIXES, RENAMED


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sub(c: str, pattern: str, to: str = "\\1") -> str:
    return f"regexp_replace({c}, {_text(pattern)}, {_text(to)})"


def _tidy(c: str) -> str:
    return f"trim(regexp_replace({c}, '[\\s\\x{{00A0}}]+', ' ', 'g'))"


_OTHER_NAME = r"\( *(FORMERLY|FKA|F/K/A|D/B/A|DBA)[^)]*(\)|$)"
_REMARK = "AND ((ITS|VARIOUS) )?(AFFILIATES|SUBSIDIARIES)|CONSOLIDATED( (REPORT|REPORTING|FILING))?|ON ITS OWN BEHALF"
_PLACE = "(NORTH AMERICA|USA|US|AMERICA)"


def _step(n: int) -> str:
    """One round of taking the end off a key."""
    legal = _sub("k", f"^(.+) ({'|'.join(sorted(LEGAL_SUFFIXES))})$")
    place = f"case when regexp_matches(k, '(^| )(OF|FOR|IN|THE|TO) {_PLACE}$') then k when k like '_% NORTH AMERICA' then left(k, -14) else {_sub('k', '^(.+) (USA|US|AMERICA)$')} end"
    return f"""e{n}a as (select client_id, {legal} as k from e{n - 1}), e{n}b as (select client_id, {place} as k from e{n}a), e{n}c as (select client_id, {place} as k from e{n}b), e{n} as (select client_id, {_sub('k', '^(.+?)( (AND|OF|THE))+$')} as k from e{n}c)"""


#: ck: client_id, client_key, excluded.
CLIENT_KEYS = f"""n0 as (select id as client_id, {_tidy("upper(coalesce(name, ''))")} as k from clients), n1 as (select client_id, {_tidy(f"regexp_replace(k, {_text(_OTHER_NAME)}, '', 'g')")} as k from n0),
    n2 as (select client_id, case when contains(k, '(') <> contains(k, ')') then {_tidy("regexp_replace(k, '[()]', ' ', 'g')")} else k end as k from n1), n3 as (select client_id, {_sub('k', '^.+ (ON BEHALF OF|OBO) (.+)$', chr(92) + '2')} as k from n2),
    n4 as (select client_id, {_sub(_sub('k', '^(.+?) (FKA|F/K/A|FORMERLY) .*$'), '^THE (.+)$')} as k from n3), n5 as (select client_id, {_sub(_sub('k', '^(.+) AND (?:ITS )?AFFILIATES$'), '^(.+) AND (?:(?:ITS|VARIOUS) )?SUBSIDIARIES$')} as k from n4),
    n6 as (select client_id, k, trim(regexp_extract(k, '^(.+)\\(([^()]*)\\)$', 1)) as base, trim(regexp_extract(k, '^(.+)\\(([^()]*)\\)$', 2)) as aside from n5), n7 as (select *, regexp_replace(aside, '[-. ]', '', 'g') as letters from n6),
    n8 as (select client_id, case when base <> '' and (regexp_full_match(aside, {_text(_REMARK)}) or (regexp_full_match(letters, '[A-Z]{{2,10}}') and regexp_matches(replace(base, ' ', ''), array_to_string(string_split(letters, ''), '.*')))) then base else k end as k from n7),
    e0 as (select client_id, {_tidy("regexp_replace(replace(k, '&', ' AND '), '[.,''" + '"' + "]', '', 'g')")} as k from n8), {', '.join(_step(n) for n in range(1, 5))},
    ren as (select * from (values {', '.join(f'({_text(a)}, {_text(b)})' for a, b in RENAMED.items())}) t(a, b)),
    ck as (select client_id, coalesce(nullif(coalesce(b, k), ''), '#' || client_id) as client_key, coalesce(b, k) in ({', '.join(map(_text, EXCLUDED_KEYS))}) as excluded from e4 left join ren on a = k)"""

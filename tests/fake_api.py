"""A client of the paged API, in memory."""

from tallyspark.sources.api import TooManyRequests

CALLS = []


def filing(n, **more):
    return {"filing_uuid": f"50b22d07-6e1a-420d-ae91-{n:012d}", "filing_year": 2024, "filing_period": "first_quarter", "filing_type": "Q1", "income": "1,000.50", "registrant": {"id": "7", "name": "R"}, "client": {"id": "8", "name": "C  Co"},
            "filing_date": "2024-04-10T00:00:00-04:00", "lobbying_activities": [{"description": "taxes", "general_issue_code": "TAX", "government_entities": [{"name": "SENATE"}, {"name": "White House Office"}]}, {"description": " "}]} | more


def fetch(year, kind, page, posted_after):
    CALLS.append(page)
    if page == 2 and CALLS.count(2) == 1:
        raise TooManyRequests
    if kind != "Q1":
        return {"results": []}
    return {"results": [filing(page * 10 + i) for i in range(3)], "next": page < 3}

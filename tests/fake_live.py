"""A client of the paged API with a few filings a period; one period fails, and a copy that has drifted."""


def filing(year, quarter, n, **more):
    return {"filing_uuid": f"50b22d07-6e1a-420d-{year}-{quarter:02d}{n:010d}", "filing_year": year, "filing_period": ["first", "second", "third", "fourth"][quarter - 1] + "_quarter", "filing_type": f"Q{quarter}", "income": str(100 * n + 1),
            "registrant": {"id": "7", "name": "Reg"}, "client": {"id": f"1{n % 2}", "name": f"Client {n % 2}, Inc."}, "filing_date": f"{year}-0{quarter * 3 + 1}-1{n}T00:00:00-04:00",
            "lobbying_activities": [{"description": "taxes", "general_issue_code": "TAX"}, {"description": "trade", "general_issue_code": "TRD"}]} | more


def fetch(year, kind, page, posted_after):
    if (year, kind) == (2024, "Q2"):
        raise ValueError("no answer")
    if year not in (2023, 2024) or kind not in ("Q1", "Q2"):
        return {"results": []}
    return {"results": [filing(year, int(kind[1]), n) for n in range(3 if kind == "Q1" else 2)]}


def drifted(year, kind, page, posted_after):
    if (year, kind) == (2024, "Q2"):
        return {"results": []}
    got = fetch(year, kind, page, posted_after)["results"]
    if (year, kind) == (2023, "Q1"):
        got = [got[0] | {"income": "999"}, got[1] | {"lobbying_activities": []}]
    return {"results": got}

"""Topic rules of our own for the queries: phrases that descriptions of these subjects use."""

RULES = {
    "topics": [
        {"id": "patient_care", "label": "Patient Care", "issue_codes": ["HCR", "MMM", "MED"], "keywords": ["telehealth visits", "telehealth", "hospitals", "nurses", "maternal care", "dialysis", "surgeons", "clinics"], "programs": ["nursing home staffing"], "acts": ["hospital copay flexibility act"], "exclude": ["veterans claims"]},
        {"id": "drug_prices", "label": "Drug Prices", "issue_codes": ["PHA", "HCR"], "keywords": ["drug rebates", "insulin copays", "pharmacists", "prescriptions", "biosimilar approval"], "programs": ["pharmacy networks"], "acts": ["patient copay resilience act"]},
        {"id": "business_tax", "label": "Business Tax", "issue_codes": ["TAX", "BUD"], "keywords": ["bonus depreciation", "interest deduction limits", "tax", "excises", "write-offs", "surtaxes", "levies"], "programs": ["opportunity zone basis"], "acts": ["excise deduction transparency act"]},
        {"id": "power_grid", "label": "Power Grid", "issue_codes": ["ENG", "UTI"], "keywords": ["grid interconnection queues", "transmission siting", "turbines", "reactors", "kilowatts", "utilities"], "programs": ["rooftop solar metering"], "acts": ["grid interconnection parity act"], "allow_single_support_relaxed": True},
        {"id": "farm_support", "label": "Farm Support", "issue_codes": ["AGR", "FOO", "ANI"], "keywords": ["crop insurance", "dairy price floors", "hay", "hogs", "silos", "barley", "feed shortages"], "programs": ["soil health payments"], "acts": ["dairy seed parity act"]},
        {"id": "border_trade", "label": "Border Trade", "issue_codes": ["TRD", "TAR"], "keywords": ["tariff", "tariffs", "sanctions", "antidumping orders", "duty drawback", "rules of origin", "embargoes"], "programs": ["trade adjustment aid"], "acts": ["export origin resilience act"]},
        {"id": "data_privacy", "label": "Data Privacy", "issue_codes": ["CPI", "TEC", "COM"], "keywords": ["privacy", "children online privacy", "encryption", "data broker registration", "algorithms"], "programs": ["digital identity wallets"], "acts": ["spectrum encryption oversight act"]},
        {"id": "freight", "label": "Freight", "issue_codes": ["TRU", "RRR", "MAR", "ROD"], "keywords": ["container chassis", "truck driver hours", "freight rail crossings", "locomotives", "tugboats", "bus"], "programs": ["highway trust outlays"], "acts": ["runway towers stability act"], "exclude": ["airport gate leases"]},
    ]
}
#: Phrases and labels of a small dictionary; the short ones match as words only.
DICTIONARY = (("grain storage", "farms"), ("hay", "farms"), ("hogs", "farms"), ("tax", "taxes"), ("bus", "roads"), ("wage theft", "work"), ("union elections", "work"), ("smog", "air"), ("mercury emissions", "air"), ("reserve pay", "forces"))

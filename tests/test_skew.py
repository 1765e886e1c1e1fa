"""A hot key end to end: one patient holds a third of all encounters.
The fact must stay exact (flags against a brute-force pairwise check) and
its plan must not compare pairs of that patient's stays."""

import datetime as dt
import random
from decimal import Decimal

from wardstar.plans.star import build_star

from test_readmission import brute


def test_hot_patient_fact(spark):
    rnd = random.Random(3)
    base = dt.datetime(2001, 1, 1)
    enc = []
    for i in range(1, 1501):
        pid = 7 if i % 3 == 0 else rnd.randrange(1, 200)   # patient 7: a third of the rows
        start = base + dt.timedelta(hours=rnd.randrange(0, 24 * 120))
        typ = rnd.choice(["Inpatient", "Outpatient", "ER"])
        dis = start + dt.timedelta(hours=rnd.choice([1, 4, 30, 72]))
        enc.append((i, pid, 1 + i % 5, typ, start, dis, 1 + i % 2, base))
    e = spark.createDataFrame(enc, "encounter_id long, patient_id long, provider_id long, encounter_type string, "
                                   "encounter_date timestamp_ntz, discharge_date timestamp_ntz, department_id int, "
                                   "last_updated timestamp_ntz")
    src = {
        "encounters": e,
        "patients": spark.createDataFrame([(p, "F", "L", dt.date(1970, 1, 1), "F", f"M{p}", base) for p in range(1, 200)],
                                          "patient_id long, first_name string, last_name string, date_of_birth date, "
                                          "gender string, mrn string, last_updated timestamp_ntz"),
        "providers": spark.createDataFrame([(p, "Dr", f"P{p}", "MD", 1, 1, base) for p in range(1, 6)],
                                           "provider_id long, first_name string, last_name string, credential string, "
                                           "specialty_id int, department_id int, last_updated timestamp_ntz"),
        "specialties": spark.createDataFrame([(1, "S", "SP01", base)], "specialty_id int, specialty_name string, "
                                             "specialty_code string, last_updated timestamp_ntz"),
        "departments": spark.createDataFrame([(1, "A", 1, 10, base), (2, "B", 2, 20, base)],
                                             "department_id int, department_name string, floor int, capacity int, "
                                             "last_updated timestamp_ntz"),
        "diagnoses": spark.createDataFrame([(1, "D01", "d", base)], "diagnosis_id long, icd10_code string, "
                                           "icd10_description string, last_updated timestamp_ntz"),
        "procedures": spark.createDataFrame([(50, "C0005", "c", base)], "procedure_id long, cpt_code string, "
                                            "cpt_description string, last_updated timestamp_ntz"),
        "encounter_diagnoses": spark.createDataFrame([(i, 1, 1, base) for i in range(1, 1501, 2)],
                                                     "encounter_id long, diagnosis_id long, diagnosis_sequence int, "
                                                     "last_updated timestamp_ntz"),
        "encounter_procedures": spark.createDataFrame([(i, 50, dt.date(2001, 2, 1), base) for i in range(1, 1501, 3)],
                                                      "encounter_id long, procedure_id long, procedure_date date, "
                                                      "last_updated timestamp_ntz"),
        "billing": spark.createDataFrame([(i, i, Decimal("10.00"), Decimal("8.00"), dt.date(2001, 3, 1), "Paid", base)
                                          for i in range(1, 1501)],
                                         "billing_id long, encounter_id long, claim_amount decimal(12,2), "
                                         "allowed_amount decimal(12,2), claim_date date, claim_status string, "
                                         "last_updated timestamp_ntz"),
    }
    fact = build_star(src, "2001-08-02")["fact_encounters"]
    got = {r.encounter_id: r.is_readmission for r in fact.select("encounter_id", "is_readmission").collect()}
    want = brute([(r[0], r[1], r[3], r[4], r[5]) for r in enc])
    assert got == want
    assert sum(want.values()) > 100  # the hot patient really readmits a lot

"""Writes small raw files shaped like the published ones, from plain Python rows."""

import csv
import io
import zipfile

from tallymart.plans import contracts as C

AE_HEADERS = {
    "period": "Period",
    "org_code": "Org Code",
    "parent_org": "Parent Org",
    "org_name": "Org name",
    "a_e_attendances_type_1": "A&E attendances Type 1",
    "a_e_attendances_type_2": "A&E attendances Type 2",
    "a_e_attendances_other_a_e_department": "A&E attendances Other A&E Department",
    "a_e_attendances_booked_appointments_type_1": "A&E attendances Booked Appointments Type 1",
    "a_e_attendances_booked_appointments_type_2": "A&E attendances Booked Appointments Type 2",
    "a_e_attendances_booked_appointments_other_department": "A&E attendances Booked Appointments Other Department",
    "attendances_over_4hrs_type_1": "Attendances over 4hrs Type 1",
    "attendances_over_4hrs_type_2": "Attendances over 4hrs Type 2",
    "attendances_over_4hrs_other_department": "Attendances over 4hrs Other Department",
    "attendances_over_4hrs_booked_appointments_type_1": "Attendances over 4hrs Booked Appointments Type 1",
    "attendances_over_4hrs_booked_appointments_type_2": "Attendances over 4hrs Booked Appointments Type 2",
    "attendances_over_4hrs_booked_appointments_other_department": (
        "Attendances over 4hrs Booked Appointments Other Department"
    ),
    "patients_who_have_waited_4_12_hs_from_dta_to_admission": (
        "Patients who have waited 4-12 hs from DTA to admission"
    ),
    "patients_who_have_waited_12_hrs_from_dta_to_admission": "Patients who have waited 12+ hrs from DTA to admission",
    "emergency_admissions_via_a_e_type_1": "Emergency admissions via A&E - Type 1",
    "emergency_admissions_via_a_e_type_2": "Emergency admissions via A&E - Type 2",
    "emergency_admissions_via_a_e_other_a_e_department": "Emergency admissions via A&E - Other A&E department",
    "other_emergency_admissions": "Other emergency admissions",
}


def waiting_header(name):
    if name.startswith("gt_"):
        return " ".join(w.capitalize() for w in name.removesuffix("_sum_1").split("_")) + " SUM 1"
    fixed = {
        "rtt_part_type": "RTT Part Type",
        "rtt_part_description": "RTT Part Description",
        "patients_with_unknown_clock_start_date": "Patients with unknown clock start date",
    }
    return fixed.get(name, name.replace("_", " ").title())


def csv_text(columns, headers, rows):
    out = io.StringIO()
    writer = csv.writer(out)
    writer.writerow([headers(c) for c in columns])
    for row in rows:
        writer.writerow(["" if row.get(c) is None else row[c] for c in columns])
    return out.getvalue()


def write_ae(path, rows, columns=None):
    columns = columns or list(AE_HEADERS)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(csv_text(columns, AE_HEADERS.get, rows))


def ae_row(period, code, name, region, base):
    row = {"period": period, "org_code": code, "org_name": name, "parent_org": region}
    for i, c in enumerate(C.EMERGENCY_COUNTS):
        attended = "attendances" in c and "over_4hrs" not in c
        row[c] = base * 10 + i if attended else base + i
    return row


def ae_total(rows):
    total = {"period": "TOTAL", "org_code": "TOTAL", "org_name": "TOTAL", "parent_org": "TOTAL"}
    for c in C.EMERGENCY_COUNTS:
        total[c] = sum(r[c] or 0 for r in rows)
    return total


def waiting_row(period, parent, provider, function, bands, part="Part_2", total=None):
    """``bands`` maps a week to its count."""
    row = {
        "period": period,
        "provider_parent_org_code": parent[0],
        "provider_parent_name": parent[1],
        "provider_org_code": provider[0],
        "provider_org_name": provider[1],
        "commissioner_parent_org_code": None,
        "commissioner_parent_name": "NA",
        "commissioner_org_code": "X24",
        "commissioner_org_name": " padded ",
        "rtt_part_type": part,
        "rtt_part_description": "Incomplete Pathways" if part == "Part_2" else "Completed",
        "treatment_function_code": function[0],
        "treatment_function_name": function[1],
        "total_all": sum(bands.values()) if total is None else total,
    }
    names = C.band_columns()
    row.update({names[w]: n for w, n in bands.items()})
    return row


def waiting_csv(rows):
    return csv_text(C.WAITING_TEXT + C.WAITING_COUNTS, waiting_header, rows)


def write_zip(path, members):
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, text in members.items():
            archive.writestr(name, text)

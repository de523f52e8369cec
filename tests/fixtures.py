"""Small deliveries, written the way a producer drops them."""

import csv
import hashlib
import io
import os

from strata.plans.hr import CHANGES, DEPARTMENT, EMPLOYEE

FEEDS = {f.name: f for f in (EMPLOYEE, DEPARTMENT, CHANGES)}
SIDECAR_HEADER = ["file_name", "record_count", "md5", "business_date", "feed", "domain"]


def employee(eid, day, **over):
    row = {
        "employee_id": eid,
        "employee_number": f"E{eid:04d}",
        "first_name": f"First{eid}",
        "last_name": f"Last{eid}",
        "email": f"p{eid}@example.org",
        "job_grade": "L3",
        "is_people_manager": "false",
        "job_title": "Clerk",
        "salary_annual": "50000.00",
        "hire_date": "2020-01-01",
        "employment_type": "full_time",
        "is_employed": "true",
        "dept_id": 1,
        "manager_id": "",
        "location_code": "NORTH",
        "home_city": "Town",
        "home_state": "ST",
        "home_postcode": "1000",
        "date_of_birth": "1990-01-01",
        "gender": "X",
        "snapshot_date": day,
    }
    return {**row, **over}


def department(did, day, **over):
    row = {
        "dept_id": did,
        "dept_code": f"D{did}",
        "dept_name": f"Department {did}",
        "parent_dept_id": "",
        "is_active": "true",
        "cost_centre": "CC1" if did in (1, 2) else "CC2",
        "location_code": "NORTH",
        "snapshot_date": day,
    }
    return {**row, **over}


def change(eid, event, received, **over):
    row = {
        "employee_id": eid,
        "event_date": event,
        "attribute_name": "job_grade",
        "old_value": "L3",
        "new_value": "L4",
        "received_date": received,
    }
    return {**row, **over}


def text(header, rows):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n")
    writer.writerow(header)
    writer.writerows(rows)
    return out.getvalue()


def drop(root, feed, day, name, rows, *, header=None, raw=None, mtime=None, sidecar=True, count=None, md5=None):
    """Write ``<root>/<feed>/<day>/<name>.csv`` and its ``.ctrl``; returns the data file's path."""
    folder = root / feed / day
    folder.mkdir(parents=True, exist_ok=True)
    names = FEEDS[feed].column_names
    if raw is None:
        values = [[r[c] for c in names] if isinstance(r, dict) else r for r in rows]
        raw = text(header or names, values)
    path = folder / f"{name}.csv"
    path.write_text(raw)
    if sidecar:
        declare(root, feed, day, f"{name}.csv", len(rows) if count is None else count,
                hashlib.md5(raw.encode()).hexdigest() if md5 is None else md5)
    if mtime:
        os.utime(path, (mtime, mtime))
    return path


def declare(root, feed, day, file_name, count, md5, business_date=None, ctrl_name=None):
    folder = root / feed / day
    folder.mkdir(parents=True, exist_ok=True)
    ctrl = folder / (ctrl_name or file_name.replace(".csv", ".ctrl"))
    ctrl.write_text(text(SIDECAR_HEADER, [[file_name, count, md5, business_date or day, feed, "hr"]]))
    return ctrl


def standard(root):
    """Two snapshots of 6 people in 3 departments (the third is empty), and some changes."""
    for day in ("2025-01-31", "2025-02-28"):
        people = [
            employee(1, day, dept_id=1, is_people_manager="true", salary_annual="90000.00"),
            employee(2, day, dept_id=1, employment_type="part_time", salary_annual="30000.50"),
            employee(3, day, dept_id=1, salary_annual="50000.25" if day < "2025-02" else "51000.25"),
            employee(4, day, dept_id=2, salary_annual="60000.00"),
            employee(5, day, dept_id=2, is_employed="false"),
            employee(6, day, dept_id=2, employment_type="contract", email="no-at-sign"),
        ]
        drop(root, "employee", day, f"employee_{day}", people)
        drop(root, "department", day, f"department_{day}", [department(i, day) for i in (1, 2, 3)])
    drop(root, "employee_changes", "2025-02-01", "changes_2025-02-01",
         [change(3, "2025-01-20", "2025-02-01"), change(4, "2025-02-01", "2025-02-01")])
    drop(root, "employee_changes", "2025-02-02", "changes_2025-02-02", [])
    return str(root)

"""Notices and cases from pages."""

from lawloom.sources import regulators as rg


def page(*rows):
    return "<html><table>" + "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows) + "</table></html>"


def link(n):
    return f"<a title='t' href='x.asp?SV={n}'> {n} </a>"


def frame(spark, rows, key):
    return spark.createDataFrame(rows, f"{key} string, html string")


def test_notices_with_and_without_their_pages(spark):
    lists = frame(spark, [("1", page(("No", "Name", "Type", "Date", "LA", "SIC"), (link(30), " A Ltd ", "Prohibition", "01/02/2024", "Leeds", "123"), (link(31), "B", "Improvement", "3-4-2023", "York", ""))), ("2", page((link(30), "A Ltd", "Prohibition", "01/02/2024", "Leeds", "123"))), ("3", None)], "page")
    told = frame(spark, [("30", page(("a", "b", "HSE Directorate", "FIELD OPERATIONS"), ("Compliance Date", "05/06/2024", "Revised Compliance Date", "07/06/2024"), ("Description", " Guard the saw. "), ("Main Activity", "41 - Building"), ("Industry", "Construction"), ("Result", "Complied"), ("Other", "x"))), ("99", page(("Result", "none")))], "regulator_id")
    breaches = frame(spark, [("30", page(("h", "h", "h", "Breach", "h"), ("1", "", "", "HSWA 1974 / 2 / 1", ""), ("2", "", "", "PUWER 1998 / 11", "")))], "regulator_id")
    got = {r.regulator_id: r.asDict() for r in rg.notices(lists, told, breaches).collect()}
    assert set(got) == {"30", "31"}
    assert got["30"] == {
        "regulator_id": "30", "offender_name": "A Ltd", "offence_action_type": "Prohibition", "offence_action_date": "2024-02-01", "offender_local_authority": "Leeds", "offender_sic": "123", "regulator_function": "Field Operations",
        "offence_compliance_date": "2024-06-05", "offence_revised_compliance_date": "2024-06-07", "offence_description": "Guard the saw.", "offender_main_activity": "41 - Building", "offender_industry": "Construction", "offence_result": "Complied", "offence_breaches": ["HSWA 1974 / 2 / 1", "PUWER 1998 / 11"],
    }
    assert got["31"]["offence_action_date"] == "2023-4-3" and got["31"]["offence_breaches"] == [] and got["31"]["offence_result"] is None
    assert rg.notices(lists.limit(0), told, breaches).count() == 0


def test_compliance_date_without_a_revised_one(spark):
    told = frame(spark, [("1", page(("Compliance Date", "05/06/2024", "", ""), ("Result", "first"), ("Result", "last")))], "regulator_id")
    r = rg.details(told, "regulator_id", rg.NOTICE_LABELS).first()
    assert (r.offence_compliance_date, r.offence_revised_compliance_date, r.offence_result) == ("2024-06-05", None, "last")


def test_cases(spark):
    lists = frame(spark, [("1", page((link(4411), "C plc", "09/10/2020", "Hull", "Farming"), (link(4412), "D", "09/10/2021", "Bath", "Ports")))], "page")
    told = frame(spark, [("4411", page(("x", "y", "<b>HSE Directorate</b>", "WALES AND WEST"), ("<b>Industry</b>", "Agriculture"), ("<b>Main Activity</b>", "Cattle"), ("<b>Total Fine</b>", "£10,000.50", "<b>Total Costs Awarded to HSE</b>", "£900")))], "regulator_id")
    breaches = frame(spark, [("4411", page(("", "", "Hearing Date", "Result", "", "Breach"), ("1", "", "01/03/2021", "Guilty", "", "HSWA 1974 / 2"), ("2", "", "02/03/2021", "Fined", "", "LOLER 1998 / 8")))], "regulator_id")
    related = frame(spark, [("4411", page((link(7), "a", "b", "c", "d"), ("8", "a", "b", "c", "d"), (link(9), "a", "b", "c", "d")))], "regulator_id")
    got = {r.regulator_id: r for r in rg.cases(lists, told, breaches, related).collect()}
    r = got["4411"]
    assert (r.offence_fine, r.offence_costs, r.offence_number, r.offence_result, r.offence_hearing_date) == (10000.5, 900.0, 2, "Fined", "2021-03-02")
    assert r.offence_breaches == ["HSWA 1974 / 2", "LOLER 1998 / 8"] and r.offender_related_cases == "HSE_7,HSE_9" and r.offender_main_activity == "Cattle"
    assert r.regulator_regulator_function == "HSE_Wales And West" and got["4412"].offence_number == 0 and got["4412"].offender_main_activity == "Ports" and got["4412"].offence_breaches == []

"""Annotated acts, numbering of parts, and templates of fitness, against given cases and plain versions."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from lawloom.operators import annotations as an
from lawloom.operators import fitness as ft
from lawloom.operators import rules as ru
from lawloom.operators import schemes as sc


def lines(text):
    return [x.strip() for x in text.strip().split("\n")]


#: Which rules, lines, and what they become.
CASES = {
    "clauses": (an.FIRST[1:5], """F578 By S. I.
        F438Definition substituted by Agriculture Act 1986
        F535 Sch. ZA1 inserted
        F903Para reference (a)
        F54In s. 1(7) the definition of "local authority"
        F121964 c. 29.""", """🔻F578🔻 By S.I.
        🔻F438🔻 Definition substituted by Agriculture Act 1986
        🔻F535🔻 Sch. ZA1 inserted
        🔻F903🔻 Para reference (a)
        🔻F54🔻 In s. 1(7) the definition of "local authority"
        🔻F12🔻 1964 c. 29."""),
    "parts": (an.FIRST[5:7], """[F508Part 2AU.K.Regulation of provision of infrastructure
        F902[PART IIIAE+W Promotion of the Efficient Use of Water
        [F690CHAPTER 2AE+W[F691Supply duties etc: water supply licensees]""", """[::part::][F508 Part 2A Regulation of provision of infrastructure [::region::]U.K.
        [::part::]F902 [PART IIIA Promotion of the Efficient Use of Water [::region::]E+W
        [::chapter::][F690 CHAPTER 2A [F691Supply duties etc: water supply licensees] [::region::]E+W"""),
    "schedules": (an.ANNEX[4:6], """F682 SCHEDULE 12E+W+S Procedure in Connection
        [F535SCHEDULE ZA1E+WBirds which re-use their nests
        F1546F1546SCHEDULE 1E+W""", """[::annex::]12 F682 SCHEDULE 12 Procedure in Connection [::region::]E+W+S
        [::annex::]ZA1 [F535 SCHEDULE ZA1 Birds which re-use their nests [::region::]E+W
        [::annex::]1 F1546F1546 SCHEDULE 1 [::region::]E+W"""),
    "tables": (an.FIRST[7:8], """[F162 Table 2
        🔻F162🔻 Sch. 1A Table 2 substituted (N.I.) (1.6.2018) by""", """[::table::][F162 Table 2
        🔻F162🔻 Sch. 1A Table 2 substituted (N.I.) (1.6.2018) by"""),
    "sections made": (an.MAIN[3:4], """🔻F2🔻 S. 1A inserted
        🔻F37🔻 S. 16A repealed (E.W.) (6.4.2010) by
        🔻F144🔻 S. 17B title substituted
        🔻F110🔻 S. 44A inserted
        🔻F438🔻 S. 29C inserted
        [F21AWater Services
        F5[F36[F3716ATransfer of authorisationsU.K.
        17B[F144Meaning of supply
        [ 44A F110 Injunctions. E+W
        X2[F43829C Consumer complaintsU.K.
        F26Other (1) text""", """🔻F2🔻 S. 1A inserted
        🔻F37🔻 S. 16A repealed (E.W.) (6.4.2010) by
        🔻F144🔻 S. 17B title substituted
        🔻F110🔻 S. 44A inserted
        🔻F438🔻 S. 29C inserted
        [::section::]1A [F2 1A Water Services
        [::section::]16A F5[F36[F37 16A Transfer of authorisationsU.K.
        [::section::]17B 17B [F144 Meaning of supply
        [::section::]44A [44A F110 Injunctions. E+W
        [::section::]29C X2 [F438 29C Consumer complaintsU.K.
        F26Other (1) text"""),
    "sections changed": (an.MAIN[4:5], """🔻F529🔻 S. 195 substituted
        🔻F1205🔻 S. 145 and ... repealed
        🔻F886🔻 S. 91 substituted
        F530[F529195 Maps of waterworks.E+W
        [F88691 [F887 Old Welsh
        F1205145. . . . . .""", """🔻F529🔻 S. 195 substituted
        🔻F1205🔻 S. 145 and ... repealed
        🔻F886🔻 S. 91 substituted
        [::section::]195 F530[F529 195 Maps of waterworks.E+W
        [::section::]91 [F886 91 [F887 Old Welsh
        [::section::]145 F1205 145  . . . . ."""),
    "lists of sections": (an.MAIN[5:7], """🔻F4🔻 Ss. 1A-1H, 1J (with a reference) substituted for Ss. 1, 2 (S.) (1.10.2011) by
        🔻F5🔻 Ss. 1-24 repealed (S.) (1.9.2018) by
        [F4[F51AMeaning of “radioactive material”U.K.
        [F51BNORM industrial activitiesU.K.
        F5[F115 Further exemptions from ss. 13 and 14.E+W""", """🔻F4🔻 Ss. 1A-1H, 1J (with a reference) substituted for Ss. 1, 2 (S.) (1.10.2011) by
        🔻F5🔻 Ss. 1-24 repealed (S.) (1.9.2018) by
        [::section::]1A [F4[F5 1A Meaning of “radioactive material”U.K.
        [::section::]1B [F5 1B NORM industrial activitiesU.K.
        [::section::]15 F5[F1 15 Further exemptions from ss. 13 and 14.E+W"""),
    "ranges of sections": (an.MAIN[:2], """45,46. . . . . . . . . . . . . .F16 U.K.
        Textual Amendments
        🔻F16🔻 Ss. 45, 46 repealed""", """[::section::]45 F16 45 . . . . . . [::region::]U.K.
        [::section::]46 F16 46 . . . . . . [::region::]U.K.
        Textual Amendments
        🔻F16🔻 Ss. 45, 46 repealed"""),
    "ranges of schedules": (an.ANNEX[:2], """SCHEDULES 1—2.U.K. . . . F39
        Textual Amendments
        🔻F39🔻 Schs. 1-4 repealed by Finance
        F125SCHEDULES 9—10E+W. .""", """[::annex::]1 F39 SCHEDULE 1 . . . . . [::region::]U.K.
        [::annex::]2 F39 SCHEDULE 2 . . . . . [::region::]U.K.
        Textual Amendments
        🔻F39🔻 Schs. 1-4 repealed by Finance
        [::annex::]9 F125 SCHEDULE 9 . . [::region::]E+W
        [::annex::]10 F125 SCHEDULE 10 . . [::region::]E+W"""),
    "subsections": (an._subsections("sub_section"), """[F18(6)For
        F1126  (1)No person may
        F34( 2 ). . .
        F28 [(4A)In any proceedings under subsection
        F60[(7)In any proceedings
        F383[F384(1). . .
        [F39(za)if those waters are in Wales
        F7(1)—(2) . .
        (3)(4) . .F8
        (5) Text F9""", """[::sub_section::]6 [F18 (6) For
        [::sub_section::]1 F1126 (1) No person may
        [::sub_section::]2 F34 (2) . . .
        [::sub_section::]4A F28 [(4A) In any proceedings under subsection
        [::sub_section::]7 F60[ (7) In any proceedings
        [::sub_section::]1 F383[F384 (1) . . .
        [F39(za)if those waters are in Wales
        [::sub_section::]1 F7 (1)  . .
        [::sub_section::]2 F7 (2)  . .
        [::sub_section::]3 F8 (3)  . .
        [::sub_section::]4 F8 (4)  . .
        [::sub_section::]5 F9 (5) Text"""),
    "cross-headings": (an.FIRST[13:14], """🔻F87🔻 Ss. 12A-12I and cross-heading inserted
        🔻F678🔻 Words in s. 63AA cross-heading substituted
        🔻F1569🔻 Sch. 2 para. 4A and preceding cross-heading inserted
        [F87Modification of appointment conditions: EnglandE+W
        [F677Supply by [F678water supply licensee] etcE+W
        [F1569Exclusion of transfer of licenceU.K.""", """🔻F87🔻 Ss. 12A-12I and cross-heading inserted
        🔻F678🔻 Words in s. 63AA cross-heading substituted
        🔻F1569🔻 Sch. 2 para. 4A and preceding cross-heading inserted
        [::heading::][F87 Modification of appointment conditions: England [::region::]E+W
        [F677Supply by [F678water supply licensee] etcE+W
        [::heading::][F1569 Exclusion of transfer of licence [::region::]U.K."""),
    "notes": (an.FIRST[8:13], """C323Sch. 2 para. 3 applied
        Commencement Information
        I1Act wholly in force at 1.12.1991
        Extent Information
        E1Act extends to England and Wales
        Editorial Information
        X5Text of the Act
        X5Section
        [F505X5 Ploughing
        X6 None""", """[::modification::]C323 Sch. 2 para. 3 applied
        [::commencement_heading::]Commencement Information
        [::commencement::]I1 Act wholly in force at 1.12.1991
        [::extent_heading::]Extent Information
        [::extent::]E1 Act extends to England and Wales
        [::editorial_heading::]Editorial Information
        [::editorial::]X5 Text of the Act
        🔺X5🔺 Section
        [🔺F505🔺 🔺X5🔺 Ploughing
        X6 None"""),
    "paragraphs": (an.ANNEX[6:7], """🔻F1606🔻 Sch. 4A paras. 8, 9 by
        🔻F1🔻 Act repealed (except for ss. 49(1) and s. 51, Sch. 4 paras. 2, 5-9, 11) by
        [F16068(1)A care home or independent hospital.E+W
        F5[F18 Exemptions from registration under s. 7.U.K.""", """🔻F1606🔻 Sch. 4A paras. 8, 9 by
        🔻F1🔻 Act repealed (except for ss. 49(1) and s. 51, Sch. 4 paras. 2, 5-9, 11) by
        [::paragraph::]8-1 [F1606 8 (1)A care home or independent hospital.E+W
        [::paragraph::]8 F5[F1 8 Exemptions from registration under s. 7.U.K."""),
    "rest": (an.LAST, """[F43 (aa) the functions of the NRBW; or]
        F1122[ComplaintsE+W
        F77Words left out
        See F12Act""", """🔸[F43 (aa) the functions of the NRBW; or]
        [::heading::]F1122 [Complaints [::region::]E+W
        🔻F77🔻 Words left out
        See F12 Act"""),
    "regions": (an.REGIONS, """[::paragraph::]6 [F296 6 E+W+S In section 19(3)
        [::paragraph::]4 [F1603 4 E+WA hospital
        [::section::]8 F5[F1 8 Exemptions under s. 7.U.K.
        [::heading::]Title
        (1) E+W Text""", """[::paragraph::]6 [F296 6 In section 19(3) [::region::]E+W+S
        [::paragraph::]4 [F1603 4 A hospital [::region::]E+W
        [::section::]8 F5[F1 8 Exemptions under s. 7. [::region::]U.K.
        [::heading::]Title [::region::]
        (1) E+W Text"""),
}


@pytest.mark.parametrize("name", CASES)
def test_rules_of_annotation(name):
    rules, given, wanted = CASES[name]
    got = an.folded(an.Lines("\n".join(lines(given))), rules).text.split("\n")
    assert [x.rstrip() for x in got] == lines(wanted)


@pytest.mark.parametrize("span, numbers", [
    ("1-3", "1 2 3"), ("1-1C", "1A 1B 1C 1"), ("19-21B", "19 20 21 21A 21B"), ("27H-27K", "27H 27I 27J 27K 27"), ("105ZA-105ZC", "105ZA 105ZB 105ZC 105Z"), ("2Y-3B", "2Y 2Z 2 3A 3B 3"), ("7", "7"), ("3-1", ""),
])
def test_ranges_in_full(span, numbers):
    assert an.range_of(span) == numbers.split()


def test_ranges_of_double_letters_and_ranges_with_a_code_for_each_section():
    assert an.range_of("78A-78YC")[-4:] == ["78YA", "78YB", "78YC", "78"] and len(an.range_of("78A-78YC")) == 29
    clauses = an.Lines("\n".join(f"🔻F{k}🔻 Ss. 3-5 repealed by Act" for k in (9, 10, 11))).clauses(re.compile(an.MAIN[6].clause))
    assert an.in_full(clauses) == [("F11", "5"), ("F10", "4"), ("F9", "3")]


def plain_codes(rows, clause, forms, sections):
    """The rule of codes without an index: every code looks at every line."""
    pairs = sections([m for r in rows if "🔻" in r and (m := re.search(clause, r))])
    for code, number in pairs:
        for k, row in enumerate(rows):
            if not row.startswith(("🔻", "[::")):
                for pattern, to in forms(code, number, {n for _, n in pairs}):
                    row = re.sub(pattern, to, row)
                rows[k] = row
    return rows


@pytest.mark.parametrize("seed", range(5))
def test_index_of_codes_changes_nothing(seed):
    rng = random.Random(seed)
    rows = [f"🔻F{rng.randrange(1, 40)}🔻 {rng.choice(['S. %d repealed', 'Ss. %d-%d repealed', 'S. %dA inserted']).replace('%d', str(rng.randrange(1, 20)))} by Act" for _ in range(40)]
    rows += ["".join(rng.choice(["[", "F", "F1", str(rng.randrange(30)), "A", " ", "Text", ". ", "(1)", "U.K."]) for _ in range(rng.randrange(2, 9))) for _ in range(400)]
    rng.shuffle(rows)
    for rule in [x for x in an.MAIN if isinstance(x, an.Codes)]:
        assert rule(an.Lines("\n".join(rows))).rows == plain_codes(list(rows), rule.clause, rule.forms, rule.sections)


def test_annotation_of_an_act_takes_time_by_its_lines():
    def act(n):
        return "\n".join(x for k in range(1, n) for x in (f"F{k}S. {k} substituted (1.1.2000) by Act", f"[F{k}{k} Title of it.U.K.", "Some words of the section"))

    took = []
    for n in (500, 2000):
        began = time.perf_counter()
        got = an.annotate(act(n))
        took.append(time.perf_counter() - began)
        assert got.count("[::section::]") == n - 1
    assert took[1] < 12 * took[0]


@pytest.mark.parametrize("seed", range(5))
def test_rewriting_of_lines_looks_only_where_a_match_may_begin(seed):
    rng = random.Random(seed)
    parts = ["[", "F", "F1", "F22", "[::section::]", "[::region::]", "🔻", "C3", "X5", "(1)", "-", "PART", "SCHEDULE", "1", "A", " ", "  ", "Text", ". ", "U.K.", "E+W", "S", "📌", ""]
    rows = ["".join(rng.choice(parts) for _ in range(rng.randrange(9))) for _ in range(400)]
    rules = [r for r in [*an.FIRST, *an.MAIN, *an.ANNEX, *an.LAST, *an.REGIONS] if isinstance(r, an.Rewrite) and not r.whole]
    for rule in rules:
        plain = [re.sub(rule.pattern, rule.to, x, flags=re.M) for x in rows]
        plain = [re.sub(r" {2,4}", " ", y) if rule.tidy and x != y else y for x, y in zip(rows, plain)]
        assert rule(an.Lines("\n".join(rows))).text == "\n".join(plain)
    assert an._begins(r"^a[|(]\|(?:b|c(d|e))") and not an._begins("^a|b") and not an._begins("^(a)|(b)") and not an._begins("a")


def test_acts_and_other_laws(spark):
    text = "F16Ss. 45, 46 repealed by Act\n45,46. . . . . . .F16 U.K.\n🔻F16🔻 x\nSCHEDULE 1U.K. Lists\nF20Sch. 2 para. 6 repealed by Act\n[F206E+W+S In section 19(3)"
    laws = spark.createDataFrame([(1, text, "Act"), (2, text, "Regulation"), (3, None, "Act"), (4, "", "Act"), (5, text, None)], "law long, text string, type string")
    got = {r.law: r.annotated for r in an.annotated(laws, act=F.col("type") == "Act").collect()}
    assert got[2] == got[5] == text and got[3] is None and got[4] == ""
    found = an.components(an.annotated(laws.filter("law = 1")), "law").collect()
    assert [(r.component, r.number, r.region) for r in sorted(found, key=lambda r: r.line)] == [
        ("amendment", "F16", ""), ("section", "45", "U.K."), ("section", "46", "U.K."), ("amendment", "F16", ""), ("annex", "SCHEDULE", "U.K."), ("amendment", "F20", ""), ("paragraph", "6", "E+W+S"),
    ]
    assert an.components(an.annotated(laws.limit(0)), "law").count() == 0


def test_each_law_is_numbered_by_its_own_scheme(spark):
    laws = {
        "digits": (["PART 2U.K. Duties", "PART A", "Chapter 3E+W Work"], ["[::part::]2 PART 2  Duties [::region::]U.K.", "PART A", "[::chapter::]3 Chapter 3  Work [::region::]E+W"]),
        "roman": (["PART IVE+W POWERS", "chapter ISMore Rules", "PART IIIWnformation", "PART 4 of the Act"], ["[::part::]4 PART IV  POWERS [::region::]E+W", "[::chapter::]1 Chapter I More Rules [::region::]S", "[::part::]2 PART II I nformation [::region::]W", "PART 4 of the Act"]),
        "letters": (["PART B POWERS OF COURTS", "PART A", "PART CGENERAL Rules"], ["[::part::]2 PART B POWERS OF COURTS", "PART A", "[::part::]3 PART C GENERAL Rules"]),
        "none": (["Partly so", None, "[::part::][F508 Part 2A Rules [::region::]U.K.", "[::chapter::]F1 [CHAPTER IIB] Rules [::region::]S"], ["Partly so", None, "[::part::]2A [F508 Part 2A Rules [::region::]U.K.", "[::chapter::]2B F1 [CHAPTER IIB] Rules [::region::]S"]),
    }
    laws["roman"][0].pop(), laws["roman"][1].pop()
    rows = [(law, k, t) for law, (given, _) in laws.items() for k, t in enumerate(given)]
    got = sc.with_headings(spark.createDataFrame(rows, "law string, line int, text string"), "law").collect()
    assert {(r.law, r.line): r.text for r in got} == {(law, k): t for law, (_, wanted) in laws.items() for k, t in enumerate(wanted)}
    assert {r.law: r.part_scheme for r in got} == {"digits": "numeric", "roman": "roman", "letters": "alphabetic", "none": None}


@pytest.mark.parametrize("text, value", [("", "0"), ("IX", "9"), ("XLIV", "44"), ("LXXXVIII", "88"), ("XCIX", "99"), ("IIX", None), ("C", None)])
def test_numerals(spark, text, value):
    assert spark.range(1).select(sc.numeral(F.lit(text)).alias("n")).first().n == value


#: category, rule, provision, pattern, and the fields that are not empty.
FITS = [
    ("applies-to", "Where a duty is placed by these Regulations on an employer in respect of employees of that employer, the employer is, so far as is reasonably practicable, under a like duty in respect of any other person, whether at work or not, who may be affected by the work activity carried out by that employer except that the duties of the employer— ", "person_ii property person_ii_verb process person_verb person", {"person": ["employer"], "property": "whether-at-work-or-not", "person_verb": "carried-out-by", "process": ["work-activity"], "person_ii_verb": "affected-by", "person_ii": "person"}),
    ("applies-to", "Where a duty is placed by these Regulations on an employer in respect of its employees, the employer must, so far as is reasonably practicable, be under a like duty in respect of any other person at work who may be affected by the work carried out by the employer.", "person_ii property person_ii_verb process person_verb person", {"person": ["employer"], "property": "at-work", "person_verb": "carried-out-by", "process": ["work"], "person_ii_verb": "affected-by", "person_ii": "person"}),
    ("applies-to", "Information and training does extend to those persons are present in the workplace where the work is being carried out.", "person person_verb place property", {"person": ["person"], "person_verb": "present", "place": ["workplace"], "property": "where-the-work-is-being-carried-out"}),
    ("disapplies-to", "Regulations 9 (notification of work with asbestos), 18(1)(a) (designated areas) and 22 (health records) do not apply where the exposure to asbestos of employees is sporadic and of low intensity.", "person_verb plant person property", {"person_verb": "exposure-to", "plant": "asbestos", "person": ["employees"], "property": "sporadic-and-of-low-intensity"}),
    ("disapplies-to", "Designated areas do not apply where it is clear from the risk assessment that the exposure to asbestos of any employee will not exceed the control limit.", "process person_verb plant person", {"process": ["risk-assessment"], "person_verb": "exposure-to", "plant": "asbestos", "person": ["employee"]}),
    ("applies-to", "Information, instruction and training does extend to those persons are on the premises where the work is being carried out.", "person place property", {"person": ["person"], "place": ["premises"], "property": "where-the-work-is-being-carried-out"}),
    ("disapplies-to", "Health surveillance do not extend to persons who are not its employees.", "person", {"person": ["x-employee"]}),
    ("disapplies-to", "These Regulations shall not apply to or in relation to any diving project to and in relation to which the Diving at Work Regulations 1997 apply.", "process", {"process": ["diving-project"]}),
    ("disapplies-to", "These Regulations shall not apply to any workplace on a construction site which is set aside for purposes other than construction work.", "place property process", {"place": ["workplace-on-a-construction-site"], "property": "set-aside-for-purposes-other-than", "process": ["construction-work"]}),
    ("disapplies-to", "These Regulations shall not apply to or in relation to any place below ground in a mine.", "place", {"place": ["place-below-ground-in-a-mine"]}),
    ("disapplies-to", "Subject to paragraphs (7) to (10), these Regulations shall not impose any obligation in relation to a ship's work equipment (whether that equipment is used on or off the ship).", "plant process", {"plant": "ship's-work-equipment", "process": ["used-on-the-ship", "used-off-the-ship"]}),
    ("disapplies-to", "Cleanliness of plant does not apply to the employer of persons who attend a ship in dock premises for the purpose of fighting a fire or in an emergency, in respect of any ship so attended", "person place property", {"person": ["employer-of-persons"], "place": ["ship-in-dock-premises"], "property": "fighting-a-fire-or-in-an-emergency"}),
    ("disapplies-to", "These Regulations shall not apply to or in relation to the master or crew of a sea-going ship or to the employer of such persons in respect of the normal ship-board activities carried out solely by a ship's crew under the direction of the master.", "person process property", {"person": ["master-of-a-ship", "crew-of-a-ship", "employer-of-such-persons"], "process": ["normal-ship-board-activities"], "property": "carried-out-solely-by-the-crew-under-the-direction-of-the-master"}),
    ("disapplies-to", "These Regulations shall not apply to vessels which are registered outside the United Kingdom and are on passage through territorial waters.", "plant property process", {"plant": "vessels", "property": "registered-outside-the-united-kingdom", "process": ["passage-through-territorial-waters"]}),
    ("disapplies-to", "", None, {}), ("applies-to", None, None, {}), ("applies-to", "These shall apply to nothing\nof a worker", None, {}),
]


def test_fields_of_rules(spark):
    rules = spark.createDataFrame([(k, c, r, [], []) for k, (c, r, *_) in enumerate(FITS)], "k int, category string, rule string, provision array<string>, provision_number array<string>")
    got = {r.k: r for r in ft.fitnesses(rules).collect()}
    for k, (_, _, pattern, fields) in enumerate(FITS):
        assert got[k].pattern == (pattern and [f"<{f}>" for f in pattern.split()]) and got[k].matched == (pattern is not None), k
        assert {f: got[k][f] for f in ft.FIELDS if got[k][f]} == fields, k
    assert got[4].fit_id == "disapplies-to|risk-assessment|exposure-to|asbestos|employee"
    assert got[10].ppp == 'category: disapplies-to\n<plant>: "ship\'s-work-equipment"\n<process>: ["used-on-the-ship", "used-off-the-ship"]'


def test_rules_outside_great_britain_and_with_provisions(spark):
    here = "These Regulations shall apply outside Great Britain as sections 1 to 59 apply by virtue of an Order"
    rows = [("applies-to", here, []), ("applies-to", "The 1974 Act shall apply to any work outside Great Britain", ["duties"]), ("applies-to", "The Act shall apply to signs and work outside Great Britain", None), (None, here, [])]
    rules = spark.createDataFrame(rows, "category string, rule string, provision array<string>").withColumn("provision_number", F.lit(None).cast("array<string>"))
    got = [(r.category, r.pattern, r.process, r.place, r.fit_id) for r in ft.fitnesses(rules).orderBy("rule").collect()]
    assert got[0][:4] == ("extends-to", ["<provision>", "<process>", "<place>"], ["work"], ["outside-great-britain"]) and got[0][4] == "extends-to|duties|work|outside-great-britain"
    assert got[1][:3] == ("applies-to", ["<process>", "<place>"], ["other"])
    assert got[2] == ("applies-to", ["<place>"], [], ["great-britain"], "applies-to|great-britain") and len(got) == 3


def plainly(rule, kind):
    """Fields and phrases by one regular expression for each template."""
    before = {"applies-to": f".*?{ru.APPLIES}.*?", "disapplies-to": f".*?{ru.DISAPPLIES}.*?", "qualified": ".*?"}[kind]
    ways = [(t, before) for t in ft.TEMPLATES] + [(t, f".*?{ft.LIKE_DUTY}.*?") for t in ft.LIKE_DUTIES if kind == "applies-to"]
    for template, start in ways:
        m = re.search(start + ".*?".join(f"({'|'.join(ft.PHRASES[f])})" for f in template.split()), rule)
        if m:
            return template.split(), list(m.groups())
    return None


@pytest.mark.parametrize("seed", range(3))
def test_walk_over_phrases_equals_regular_expressions(seed):
    rng = random.Random(seed)
    words = ["apply to", "shall not apply to", "in", "he is under a like duty in respect of", "\n", "x", *(x for ps in ft.PHRASES.values() for p in ps for x in ft.written_out(p) if len(x) < 22)]
    met = set()
    for _ in range(250):
        rule = " ".join(rng.choice(words) for _ in range(rng.randrange(1, 7)))
        for kind in ft.BEFORE:
            found = ft.captured(rule, kind)
            assert found == plainly(rule, kind), (rule, kind)
            met.add(found and " ".join(found[0]))
    assert len(met) > 12


def test_every_template_is_met():
    for template in ft.TEMPLATES:
        rule = "Any requirement or prohibition imposed: " + " of ".join(ft._phrases()[f][0] for f in template.split())
        found = ft.captured(rule, "qualified")
        assert found is not None and ft.TEMPLATES.index(" ".join(found[0])) <= ft.TEMPLATES.index(template)
    long = "shall apply to " + " ".join(["person in asbestos at work"] * 2000)
    began = time.perf_counter()
    assert ft.captured(long, "applies-to") and time.perf_counter() - began < 5


@pytest.mark.parametrize("pattern", sorted({p for ps in ft.PHRASES.values() for p in ps}))
def test_phrases_written_out(pattern):
    out = ft.written_out(pattern)
    assert all(re.fullmatch(pattern, x) for x in out) and re.match(pattern, out[0] + " tail")[0] == out[0]

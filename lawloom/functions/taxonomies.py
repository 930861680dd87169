"""Vocabularies of the text classifiers: actors, kinds of duty, management themes.

Everything in this module is a fixed value: names, and the patterns that name them.
POSIX classes are written as such; `java` and `python` turn a pattern into the form that
Spark and Python read.
"""

from __future__ import annotations

import re

# Management themes and their patterns, in order of rank.
THEMES = {
    "Policy": ["[Pp]olicy?i?e?s?", "[Oo]bjectives?", "[Ss]trateg"],
    "Organisation": ["[Oo]rg.? chart", "[Oo]rganisation chart", "making of appointments?", "(?:must|may|shall)[ ]?(?:jointly)?[ ]?appoint", "person.*?appointed", "appoint a person"],
    "Organisation - Control": ["[Pp]rocess", "[Pp]rocedure", "[Ww]ork instruction", "[Mm]ethod statement", "[Ii]nstruction", "comply?i?e?s? with.*?(?:duties|requirements)", "is responsible for", "has control over", "must ensure, insofar as they are matters within that person’s control", "take such measures as it is reasonable for a person in his position to take", "(?:supervised?|supervising)"],
    "Organisation - Communication & Consultation": ["[Cc]omminiate?i?o?n?g?", "[Cc]onsult", "[Cc]onsulti?n?g?", "[Cc]onsultation", "(?:send a copy of it|be sent) to", "must identify to", "publish a report", "must (?:immediately )?inform[[:blank:][:punct:]—]", "report to", "(?:by|to) provide?i?n?g?.*?information", "made available to (?:the public)", "supplied (?:in writing|with a copy)", "aware of the contents of"],
    "Organisation - Collaboration, Coordination, Cooperation": ["[Cc]ollaborat", "[Cc]oordinat", "[Cc]ooperat"],
    "Organisation - Competence": ["[Cc]ompetent?c?e?y?[ ](?!authority)", "[Tt]raining", "[Ii]nformation, instruction and training", "[Ii]nformation.*?provided to every person", "provide.*?information", "person satisfies the criteria", "skills, knowledge and experience", "organisational capability", "instructe?d?"],
    "Organisation - Costs": ["[Cc]ost[- ]benefit", "[Nn]ett? cost", "[Ff]ee[[:blank:][:punct:]”]", "[Cc]harge", "[Ff]inancial loss"],
    "Records": ["(?:[Rr]ecord|[Rr]eport (?!to)|[Rr]egister)", "[Ll]ogbook", "[Ii]ventory", "[Dd]atabase", "(?:[Ee]nforcement|[Pp]rohibition|[Ii]mprovement) notice", "[Dd]ocuments?", "(?:marke?d?i?n?g?|labelled)", "must be kept", "certificate", "health and safety file"],
    "Permit, Authorisation, License": ["[ “][Pp]ermit[[:blank:][:punct:]”]", "[Aa]uthorisation", "[Aa]uthorised (?:^representative)", "[Ll]i[sc]en[sc]ed?", "[Ll]i[sc]en[sc]ing"],
    "Aspects and Hazards": ["[Aa]spects and impacts", "[Hh]azard"],
    "Planning & Risk / Impact Assessment": ["[Aa]nnual plan", "[Ss]trategic plan", "[Bb]usiness plan", "[Pp]lan of work", "construction phase plan", "written plan", "measures? to be specified in the plan", "(?:project|action) plan", "project is planned", "[Ii]mpact [Aa]ssessment", "[Rr]isk [Aa]ssessment", "assessment of any risks", "suitable and sufficient assessment", "[Ii]n making the assessment", "(?:reassess|reassessed|reassessment)", "general principles of prevention", "identify and eliminate"],
    "Risk Control": ["avoid the need", "suitable and sufficient steps", "steps as are reasonable in the circumstances must be taken", "taken? all reasonable steps", "takes immediate steps", "[Rr]isk [Cc]ontrol", "control.*?risk", "[Rr]isk mitigation", "use the best available techniques not entailing excessive cost", "eliminates.*?the risk", "reduces? the risk", "provided to.*?employees", "provision and use of", "safety management system", "corrective measures?", "meets the requirements?", "standards for the construction", "shall make full and proper use", "measures?.*?specified.*?plan", "take such measures"],
    "Notification": ["given?.*?notice", "accident report", "[Nn]otify", "[Nn]otification", "[Aa]pplication for", "publish.*?a notice"],
    "Maintenance, Examination and Testing": ["[Mm]aintenance", "[Mm]aintaine?d?", "[Ee]xamination", "[Tt]esting", "[Ii]nspecti?o?n?e?d?"],
    "Checking, Monitoring": ["[Cc]heck", "[Mm]onitor", "medical exam", "at least once every.*?years", "kept available for inspection"],
    "Review": ["[Mm]anagement review", "(?:[Rr]eviewed|is [Rr]evised)", "(?:conduct|carry out|carrying out) (?:a|the) review", "review the (?:assessment)"],
}
DEFAULT_THEME = "Risk Control"

# Kinds of provision and their patterns, in the order in which they are tried.
_DEFINED = "means|includes|does not include|is (?:information|the)|are|to be read as|are references to|consists"
KINDS = {
    "Enactment, Citation, Commencement": ["(?:Act|Regulations?|Order) may be cited as", "(?:Act|Regulations?|Order).*?shall have effect", "(?:Act|Regulations?|Order) shall come into (?:force|operation)", "comes? into force", "has effect.*?on or after", "commencement"],
    "Extent": ["(?:Act|Regulation|section)(?: does not | do not | )extends? to", "(?:Act|Regulations?|Section).*?extends? (?:only )?to", "[Oo]nly.*?extend to", "do not extend to", "[R|r]egulations under", "enactment amended or repealed by this Act extends", "[Cc]orresponding provisions for Northern Ireland", "shall not (?:extend|apply) to (?:Scotland|Wales|Northern Ireland)"],
    "Interpretation, Definition": [f"[A-Za-z\\d ]”.*?(?:{_DEFINED})[ —,]", "“.*?” is.*?[ —,]", "In thi?e?se? [Rr]egulations?.*?—", "has?v?e? the (?:same )?(?:respective )?meanings?", "(?<!prepared) [Ff]or the purposes? of (?:this Act|determining|these Regulations) ", "(?:any reference|references?).*?to", "[Ii]nterpretation", "interpreting these Regulation", "for the meaning of “", "provisions.*?are reproduced", "an?y? reference.*?in these Regulations?", "[Ww]here an expression is defined.*?and is not defined.*?it has the same meaning", "are to be read", "[Ff]or the purposes of (?:this Act|these Regulations|the definition of|subsection)"],
    "Application, Scope": ["Application", "(?:Act|Part|Chapter|[Ss]ections?|[Ss]ubsection|[Rr]egulations?|[Pp]aragraphs?|Article).*?apply?i?e?s?", "(?:Act|Part|Chapter|[Ss]ections?|[Ss]ubsection|[Rr]egulations?|[Pp]aragraphs?).*?doe?s? not apply", "(?:Act|Part|Chapter|[Ss]ections?|[Ss]ubsection|[Rr]egulations?|[Pp]aragraphs?|[Ss]chedules?).*?has effect", "This.*?was enacted.*?for the purpose of making such provision as.*?necessary in order to comply with", "does not apply", "shall.*?apply", "shall have effect", "shall have no effect", "ceases to have effect", "shall remain in force until", "provisions of.*?apply", "application of this (?:Part|Chapter|[Ss]ection)", "apply to any work outside", "apply to a self-employed person", "Save where otherwise expressly provided, nothing in.*?shall impose a duty", "need not be complied with until", "Section.*?apply for the purposes", "[Ff]or the purposes of.*?the requirements? (?:of|set out in)", "[Ff]or the purposes of paragraph", "requirements.*?which cannot be complied with are to be disregarded", "(?:[Rr]egulations|provisions) referred to", "without prejudice to (?:regulation|the generality of the requirements?)", "Nothing in.*?shall prejudice the operation", "[Nn]othing in these (?:Regulations) prevents", "shall bind the Crown"],
    "Exemption": [" shall not apply in any case where[, ]", " by a certificate in writing exempt", " exemption"],
    "Repeal, Revocation": [" \\. \\. \\. \\. \\. \\. \\. ", "(?:revoked|repealed)[ [:punct:]—]", "(?:[Rr]epeals|revocations)", "following Acts shall cease to have effect"],
    "Transitional Arrangement": ["transitional provision"],
    "Charge, Fee": [" fees and charges ", " (?:fees?|charges?).*(?:paid|payable) ", " by the (?:fee|charge) ", " failed to pay a (?:fee|charge) ", " fee.*?may not exceed the sum of the costs", " fee may include any costs", " may charge.*?a fee ", " [Aa] fee charged", "invoice must include a statement of the work done"],
    "Offence": [" ?[Oo]ffences?[ \\.,—:]", "(?:[Ff]ixed|liable to a) penalty"],
    "Enforcement, Prosecution": ["proceedings", "conviction"],
    "Defence, Appeal": [" [Aa]ppeal ", "[Ii]t is a defence for a ", "may not rely on a defence", "shall not be (?:guilty|liable)", "[Ii]t shall (?:also )?.*?be a defence", "[Ii]t shall be sufficient compliance", "rebuttable"],
    "Power Conferred": [" functions.*(?:exercis(?:ed|able)|conferred) ", " exercising.*functions ", "power to make regulations", "[Tt]he power under (?:subsection)"],
}
AMENDMENT = ["shall be inserted the words— ?\\n?“[\\s\\S]*”", "shall be inserted— ?\\n?“[\\s\\S]*”", "there is inserted", "insert the following after", " (?:substituted?|inserte?d?)—? ?\\n?“[\\s\\S]*”", "shall be (?:inserted|substituted) the words", "for.*?substitute", "omit the (?:words?|entr(?:y|ies) relat(?:ing|ed) to|entry for)", "omit the following", "[Oo]mit “?(?:section|paragraph)", "[Oo]mit[ ]+(?:section|paragraph)", "entry.*?shall be omitted", "shall be amended", "there shall be added the following paragraph", "add the following after (?:subsection|paragraph)", "[Aa]mendments?", "[Aa]mended as follows", "are amended in accordance with"]
# Kinds of duty in order of rank; others are dropped.
RANKED_KINDS = ["Duty", "Right", "Responsibility", "Power", "Enactment, Citation, Commencement", "Purpose", "Interpretation, Definition", "Application, Scope", "Extent", "Exemption", "Process, Rule, Constraint, Condition", "Power Conferred", "Charge, Fee", "Offence", "Enforcement, Prosecution", "Defence, Appeal", "Liability", "Repeal, Revocation", "Amendment", "Transitional Arrangement"]
#: Kinds whose provisions bind nobody.
UNBINDING_KINDS = ["Amendment", "Repeal, Revocation", "Interpretation, Definition"]
DEFAULT_KIND = "Process, Rule, Constraint, Condition"
#: Kinds that open a provision to the management themes.
THEMED_KINDS = ["Duty", "Right", "Responsibility", "Discretionary", DEFAULT_KIND]

# Governmental actors and their patterns.
GOVERNMENT = {
    "Crown": ["Crown"],
    "EU: Commission": ["[Cc]ommission"],
    "Gvt: Agency: Environment Agency": ["Environment Agency"],
    "Gvt: Agency: Health and Safety Executive": ["Health and Safety Executive", "[Tt]he Executive"],
    "Gvt: Agency: Health and Safety Executive for Northern Ireland": ["Health and Safety Executive for Northern Ireland", "HSENI"],
    "Gvt: Agency: Natural Resources Body for Wales": ["Natural Resources Body for Wales"],
    "Gvt: Agency: OFCOM": ["Office of Communications?", "OFCOM"],
    "Gvt: Agency: Office for Environmental Protection": ["Office for Environmental Protection", "OEP"],
    "Gvt: Agency: Office for Nuclear Regulation": ["Office for Nuclear Regulations?", "ONR"],
    "Gvt: Agency: Office of Rail and Road": ["Office of Rail and Road?"],
    "Gvt: Agency: Scottish Environment Protection Agency": ["Scottish Environment Protection Agency", "SEPA"],
    "Gvt: Agency:": ["[Aa]gency"],
    "Gvt: Appropriate Person": ["[Aa]ppropriate [Pp]ersons?"],
    "Gvt: Authority": ["(?:[Tt]he|[Aa]n|appropriate|allocating|[Cc]ompetent|[Dd]esignated) authority?i?e?s?", "[Rr]egulators?", "[Mm]onitoring [Aa]uthority?i?e?s?", "officer authorised by the relevant authority", "that authority"],
    "Gvt: Authority: Energy": ["Northern Ireland Authority for Energy Regulation", "network emergency co-ordinator", "Phoenix Natural Gas Limited", "British Gas p\\.l\\.c\\."],
    "Gvt: Authority: Enforcement": ["(?:[Rr]egulati?on?r?y?|[Ee]nforce?(?:ment|ing)) [Aa]uthority?i?e?s?"],
    "Gvt: Authority: Harbour": ["[Hh]arbour [Aa]uthority?i?e?s?", "harbour master"],
    "Gvt: Authority: Licensing": ["[Ll]icen[cs]ing [Aa]uthority?i?e?s?"],
    "Gvt: Authority: Local": ["[Ll]ocal [Aa]uthority?i?e?s?", "council of a county", "(?:county|district)(?: borough | )council", "London Borough Council", "council constituted"],
    "Gvt: Authority: Market": ["(?:market surveillance|weights and measures) authority?i?e?s?"],
    "Gvt: Authority: Public": ["[Pp]ublic [Aa]uthority?i?e?s?"],
    "Gvt: Authority: Traffic": ["[Tt]raffic [Aa]uthority?i?e?s?"],
    "Gvt: Authority: Waste": ["(?:[Ww]aste collection|[Ww]aste disposal|[Dd]isposal) [Aa]uthority?i?e?s?"],
    "Gvt: Commissioners": ["[Cc]ommissioners"],
    "Gvt: Devolved Admin: National Assembly for Wales": ["National Assembly for Wales", "Senedd", "Welsh Parliament"],
    "Gvt: Devolved Admin: Northern Ireland Assembly": ["Northern Ireland Assembly"],
    "Gvt: Devolved Admin: Scottish Parliament": ["Scottish Parliament"],
    "Gvt: Devolved Admin:": ["Assembly"],
    "Gvt: Emergency Services": ["[Ee]mergency [Ss]ervices?"],
    "Gvt: Emergency Services: Police": ["[Cc]onstable", "[Cc]hief(?: officer | )of [Pp]olice", "police force"],
    "Gvt: Judiciary": ["court", "[Jj]ustice of the [Pp]eace", "[Tt]ribunal", "[Ss]heriff", "[Mm]agistrate", "prosecutor", "Lord Advocate"],
    "Gvt: Minister": ["Secretary of State", "[Mm]inisters?"],
    "Gvt: Minister: Attorney General": ["Attorney General"],
    "Gvt: Minister: Secretary of State for Defence": ["Secretary of State for Defence"],
    "Gvt: Minister: Secretary of State for Transport": ["Secretary of State for Transport"],
    "Gvt: Ministry: Department of Enterprise, Trade and Investment": ["Department of Enterprise, Trade and Investment"],
    "Gvt: Ministry: Department of the Environment": ["Department of the Environment"],
    "Gvt: Ministry: HMRC": ["customs officer", "Her Majesty['’]s Commissioners for Revenue and Customs", "Her Majesty’s Revenue and Customs"],
    "Gvt: Ministry: Ministry of Defence": ["Ministry of Defence"],
    "Gvt: Ministry: Treasury": ["[Tt]reasury"],
    "Gvt: Ministry:": ["[Mm]inistry", "[Tt]he Department"],
    "Gvt: Officer": ["[Aa]uthorised [Oo]fficer", "[Oo]fficer of a local authority", "[Oo]fficer"],
    "Gvt: Official": ["Official"],
    "HM Forces": ["(?:His|Her) Majesty['’]s forces", "armed forces"],
    "HM Forces: Navy": ["(?:His|Her) Majesty['’]s Navy"],
}
# Governed actors and their patterns, in order of priority.
GOVERNED = {
    "Org: Investor": ["[Ii]nvestors?"],
    "Org: Owner": ["[Oo]wners?", "mine owner", "owner of a non-production installation", "installation owner"],
    "Org: Landlord": ["[Ll]andlord"],
    "Org: Lessee": ["[Ll]essee"],
    "Org: Occupier": ["[Oo]ccupiers?", "[Pp]erson who is in occupation"],
    "Org: Employer": ["[Ee]mployers?"],
    "Operator": ["[Oo]perators?", "(?:berth|mine|well|economic|meter)[[:blank:]-]operator", "operator of a production installation"],
    "Org: Company": ["[Cc]ompany?i?e?s?", "[Bb]usinesse?s?", "[Ee]nterprises?", "[Bb]ody?i?e?s? corporate"],
    "Org: Partnership": ["[Pp]artnerships?", "[Uu]nincorporated body?i?e?s?"],
    "Organisation": ["[Tt]hird party", "[Oo]rganisations?"],
    "Ind: Employee": ["[Ee]mployees?"],
    "Ind: Worker": ["[Ww]orkers?", "[Ww]orkmen", "(?:members of the )?[Ww]orkforce"],
    "Ind: Self-employed Worker": ["[Ss]elf-employed (?:[Pp]ersons?|diver)"],
    "Ind: Responsible Person": ["[Rr]esponsible [Pp]ersons?"],
    "Ind: Competent Person": ["[Cc]ompetent [Pp]ersons?", "person who is competent"],
    "Ind: Authorised Person": ["[Aa]uthorised [Pp]erson", "[Aa]uthorised [Bb]ody", "[Aa]uthorised Representative", "[Pp]erson (?:so|duly) authorised"],
    "Ind: Suitable Person": ["suitable person"],
    "Ind: Supervisor": ["[Ss]upervisor", "[Pp]erson in control", "individual in charge"],
    "Ind: Manager": ["managers?", "mine manager", "manager of a mine", "installation manager"],
    "Ind: Appointed Person": ["[Aa]ppointed [Pp]ersons?", "[Aa]ppointed body"],
    "Ind: Relevant Person": ["[Rr]elevant [Pp]erson"],
    "Ind: Young Person": ["young person", "childr?e?n?"],
    "Ind: Person": ["[Pp]ersons?", "[Ii]ndividual"],
    "Ind: Duty Holder": ["[Dd]uty [Hh]olders?", "[Dd]utyholder"],
    "Ind: Licence Holder": ["[Ll]icen[sc]e [Hh]olders?"],
    "Ind: Holder": ["[Hh]olders?"],
    "Ind: User": ["[Uu]sers?"],
    "Ind: Applicant": ["[Rr]elevant applicant", "[Aa]pplicant"],
    "Ind: Licensee": ["[Ll]icensee", "offshore licensee"],
    "Ind: Diver": ["[Dd]iver"],
    "Ind: Chair": ["[Cc]hairman"],
    "Public": ["[Pp]ublic", "[Ee]veryone", "[Cc]itizens?"],
    "Public: Parents": ["[Pp]arents?"],
    "Spc: OH Advisor": ["[Nn]urse", "[Pp]hysician", "(?:[Rr]elevant)?[ ]?[Dd]octor", "[Mm]edical examiner", "[Ee]mployment medical advis[oe]r"],
    "Spc: Employees' Representative": ["[Ee]mployees' representative", "[Ss]afety representatives?", "[Tt]rade [Uu]nions? representatives?"],
    "Spc: Trade Union": ["[Tt]rade [Uu]nions?"],
    "Spc: Assessor": ["[Aa]ssessors?"],
    "Spc: Surveyor": ["[Ss]urveyor"],
    "Spc: Inspector": ["[Uu]ser inspectorate", "[Ii]nspectors?", "[Vv]erifier", "[Ww]ell examiner"],
    "Spc: Body": ["(?:[Aa]ppropriate|[Aa]pproved|[Ss]ampling|(?:UK )?[Nn]otified|[Cc]onformity assessment) (?:] )?[Bb]ody"],
    "Spc: Advisor": ["[Aa]dvis[oe]r"],
    "Spc: Engineer": ["[Ee]ngineer"],
    "Spc: Technician": ["[Tt]echnician", "geotechnical specialist"],
    "SC: Agent": ["(?<![Bb]iological )[Aa]gents?"],
    "SC: Keeper": ["person who.*?keeps*?"],
    "SC: Manufacturer": ["[Mm]anufacturer"],
    "SC: Producer": ["[Pp]roducer", "person who.*?produces*?"],
    "SC: C: Principal Designer": ["[Pp]rincipal [Dd]esigner"],
    "SC: C: Designer": ["[Dd]esigner", "designs for another"],
    "SC: C: Constructor": ["[Cc]onstructor"],
    "SC: C: Principal Contractor": ["[Pp]rincipal [Cc]ontractor"],
    "SC: C: Contractor": ["[Cc]ontractors?", "[Dd]iving contractor", "[Cc]ompressed air contractor"],
    "SC: Marketer": ["[Aa]dvertiser", "[Mm]arketer"],
    "SC: Supplier": ["[Ss]upplier", "[Pp]erson who supplies"],
    "SC: Generator": ["[Gg]enerators?"],
    "SC: Distributor": ["[Dd]istributors?"],
    "SC: Seller": ["[Ss]eller"],
    "SC: Dealer": ["(?:[Ss]crap metal )?[Dd]ealer"],
    "SC: Retailer": ["[Rr]etailer"],
    "SC: Domestic Client": ["[Dd]omestic [Cc]lient"],
    "SC: Client": ["[Cc]lients?"],
    "SC: Customer": ["[Cc]ustomer"],
    "SC: Consumer": ["[Cc]onsumer"],
    "SC: Storer": ["[Ss]torer"],
    "SC: T&L: Consignor": ["[Cc]onsignor"],
    "SC: T&L: Handler": ["[Hh]andler", "person who.*?(?:loads|unloads)"],
    "SC: T&L: Consignee": ["[Cc]onsignee"],
    "SC: T&L: Carrier": ["[Tt]ransporter", "person who.*?(?:carries|transports)", "[Cc]arriers?"],
    "SC: T&L: Driver": ["[Dd]river"],
    "SC: Importer": ["[Ii]mporter", "person who.*?imports*?"],
    "SC: Exporter": ["[Ee]xporter", "person who.*?exports*?"],
    "Svc: Installer": ["[Ii]nstaller"],
    "Svc: Maintainer": ["[Mm]aintainer"],
    "Svc: Repairer": ["[Rr]epairer", "person who modifies or repairs", "person who repairs"],
    "Maritime: crew": ["crew of a ship"],
    "Maritime: master": ["master.*?of a ship", "master.*?of (?:the|an?y?) vessel"],
    "Env: Reuser": ["[Rr]euser"],
    "Env: Treater": [" person who.*?treats*?"],
    "Env: Recycler": ["[Rr]ecycler"],
    "Env: Disposer": ["[Dd]isposer"],
    "Env: Polluter": ["[Pp]olluter"],
    ": He": ["[Hh]e"],
}
# Phrases that hold the word of an actor and name none.
NO_ACTORS = ["local authority collected municipal waste", "[Pp]ublic (?:nature|sewer|importance|functions?|interest|[Ss]ervices)", "[Rr]epresentatives? of"]

# Phrases between an actor and a verb that is not the actor's; each becomes a blank.
NO_ROLES = ["[ ]area of the authority", "[ ]said report (?:shall|must)|shall[ ]not[ ]apply", "[ ]may[ ]be[ ](?:approved|reduced|reasonably foreseeably|required)", "[ ]may[ ]reasonably[ ]require", "[ ]as[ ]the[ ]case[ ]may[ ]be", "[ ]as may reasonably foreseeably", "[ ]and[ ](?:shall|must|may[ ]only|may[ ]not)"]

# Parts of the patterns of roles.
_MODALS = "(?:shall|must|may[ ]only|may[ ]not)"
_DETERMINERS = "(?:[Aa]n?y?|[Tt]he|[Ee]ach|[Ee]very|[Ee]ach such|[Tt]hat|[Nn]ew|,)"
_NOT_BEFORE = "(?<! by | of |send it to |given |appointing | to expose | to whom | to pay | to permit |before which )"
_NOT_BEFORE_OR_AND = "(?<! by | of |send it to |given |appointing | to expose | to whom | to pay | to permit |before which |and )"
_NOT_BETWEEN = "(?!is found to |is likely to |to a |to carry |to assess |to analyse|to perform )"
_NOT_AFTER = "(?!be entitled|be carried out by|be construed|be consulted|be notified|be informed|be appointed|be retained|be included|be extended|be treated|be necessary|be subjected|be suitable|be made|not apply|consist|have effect|apply)"
_MODAL_END = "[[:blank:][:punct:]—]"
# Patterns of the roles of an actor @, in the order in which they are listed, and whether a match is taken out of the text.
HE_DUTY = [(f"@{_MODALS}", True)]
ROLES = {
    "duty": [
        (f"Where.*?(?:an?y?|the|each|every)@.*?,[ ]he[ ]{_MODALS}", True),
        (f"{_NOT_BEFORE_OR_AND}{_DETERMINERS}@{_MODALS}{_MODAL_END}{_NOT_AFTER}", True),
        (f"{_MODALS} be (?:carried out|reviewed|prepared).*?@", False),
        (f"{_MODALS} be (?:affixed|carried out) by—$[\\s\\S]*?@", False),
        (f"{_DETERMINERS}@(?s:.)*?^{_MODALS} (?!be carried out by)", False),
        ("[Nn]o@(?:at work )?(?:shall|is to)", False),
        (f"{_NOT_BEFORE}{_DETERMINERS}@{_NOT_BETWEEN}.*?{_MODALS}{_MODAL_END}[ ]?{_NOT_AFTER}", False),
        (f"@{_NOT_BETWEEN}.*?{_MODALS}{_MODAL_END}[ ]?{_NOT_AFTER}", False),
        (f"@{_NOT_BETWEEN}[^—\\.]*?he[ ]shall", False),
        ("shall apply to a.*?@.*?as they apply to", False),
        (f"shall be the duty of {_DETERMINERS}@", False),
        (f"shall be the duty of the.*?and of {_DETERMINERS}@", False),
        ("shall be (?:selected by|reviewed by|given.*?by) the@", False),
        ("shall also be imposed on a@", False),
        ("[Nn]o@may", False),
        ("@may[ ](?:not|only)", False),
        ("requiring a@.*?to", False),
        ("@is.*?under a like duty", False),
        ("@has taken all.*?steps", False),
        ("Where a duty is placed.*?on an?@", False),
        ("provided by an?@", False),
        (f"@{_NOT_BETWEEN}.*?(?:remains|is) (?:responsible|financially liable) for", False),
        ("@.*?(?:shall be|is) liable (?!to)", False),
    ],
    "right": [
        ("Where.*?(?:an?y?|the|each|every)@.*?,[ ]he[ ]may", True),
        ("requested by a@", False),
        ("(?:shall|must) (?:be notified to the|consult).*?@", False),
        (f"may be (?:varied|terminated|presented).*?by {_DETERMINERS}@", False),
        ("@may[[:blank:][:punct:]][ ]?(?!exceed|need|have|require|be[ ]|not|only)", True),
        (f"{_NOT_BEFORE}{_DETERMINERS}@.*?(?<!which|who)[ ]may[[:blank:][:punct:]][ ]?(?!need|have|require|be[ ]|not|only)", False),
        ("@.*?shall be entitled", False),
        ("@.*?is not required", False),
        ("@may.*?, but may not", False),
        ("permission of that@", False),
        (f"may be made by {_DETERMINERS}.*?@", False),
        (f"may be made—(?s:.)*\\([a-z]\\) by {_DETERMINERS}@", False),
    ],
    "responsibility": [
        ("@(?:must|shall)(?! have the power)", False),
        ("@[^—\\.]*?(?:must|shall)(?! have the power)", False),
        ("@[^—\\.]*?[\\.\\.\\.].*?(?:must|shall)", False),
        ("must be (?:carried out|reviewed|sent|prepared|specified by).*?@", False),
        ("@[^—\\.]*?has determined", False),
        ("[Ii]t shall be the duty of a?n?[^—\\.]*?@", False),
        ("@ owes a duty to", False),
        ("is to be.*?by a@", False),
        ("@is to (?:perform|have regard)", False),
        ("@may not", False),
        ("@is (?:liable|responsible for)", False),
        ("[Ii]t is the duty of the@", False),
        ("@.*?—(?s:.)*?^.*?(?:must|shall)", False),
    ],
    "power": [
        ("@.*?may.*?by regulations?.*?(?:specify|substitute|prescribe|make)", False),
        ("@ may.*?direct ", False),
        ("@ may vary the terms", False),
        ("@ may.*make.*(?:scheme|plans?|regulations?) ", False),
        ("@ considers necessary", False),
        ("@.*?shall (?:have the power|be entitled)", False),
        ("@ may by regulations?", False),
        ("@[^—\\.]*?may(?![ ]not|[ ]be)", False),
        ("@[^—\\.]*?[\\.\\.\\.].*?may(?![ ]not)", False),
        ("@is not required", False),
        ("may be (?:varied|terminated) by the@", False),
        ("may be excluded.*?by directions of the @", False),
        (" in the opinion of the @ ", False),
        ("@.*?—(?s:.)*?^.*?may(?![ ]not|[ ]be)", False),
    ],
}

# Titles that a register leaves out (lower case).
EXCLUDED_TITLES = ["railways?.*station.*order", "railways?.*junction.*order", "(?:network rail|railways?).*(?:extensions?|improvements?|preparation|enhancement|reduction).*order", "rail freight.*order", "light railway order", "drought.*order", "restriction of flying", "correction slip", "trunk road", "harbour empowerment order", "harbour revision order", "parking places", "parking prohibition", "parking and waiting", "development consent order", "electrical system order"]


def java(pattern: str) -> str:
    """The pattern with POSIX classes as Java writes them."""
    return pattern.replace("[:blank:]", r"\p{Blank}").replace("[:punct:]", r"\p{Punct}")


def python(pattern: str) -> str:
    """The pattern with POSIX classes as Python writes them."""
    return pattern.replace("[:blank:]", r" \t").replace("[:punct:]", r"!-/:-@\[-`{-~")


def python_lines(pattern: str) -> str:
    """The pattern as Python writes it, in which a dot ends at all ends of lines that Java knows."""
    return re.sub(r"\\.|\.", lambda m: m[0] if len(m[0]) > 1 else r"[^\n\r\x85\u2028\u2029]", python(pattern))

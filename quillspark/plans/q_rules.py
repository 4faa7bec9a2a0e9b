"""Queries of the rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import mentions as N
from quillspark.functions import rules as U
from quillspark.functions import text as T
from quillspark.operators import phrases as P
from quillspark.operators import records as R
from quillspark.operators import status as S
from quillspark.plans import views as V
from quillspark.plans.registry import query

_JOINS = ["plus", "in combination with", "and", "vs", "with or without", "±", "followed by", "and/or", "compared with"]


def titles(spark: SparkSession, d: str) -> DataFrame:
    """p_partkey, a, b, title: two drugs joined by one of the phrases, the second with a dosage."""
    joined = F.element_at(F.array(*[F.lit(j) for j in _JOINS]), (F.col("p_partkey") % len(_JOINS) + 1).cast("int"))
    b = F.when(F.col("p_size") % 7 == 0, "placebo").otherwise(F.concat(F.lit("drug"), F.col("p_size").cast("string")))
    return V.table(spark, d, "part").select("p_partkey", joined.alias("phrase"), b.alias("b"), F.concat(F.lit("Agent"), F.col("p_partkey").cast("string"), F.lit(" "), joined, F.lit(" "), b, F.lit(" 20 mg")).alias("title"))


_TITLES = "titles as (select p_partkey, 'Agent' || p_partkey as a, ([" + ", ".join(f"'{j}'" for j in _JOINS) + f"])[p_partkey % {len(_JOINS)} + 1] as phrase, case when p_size % 7 = 0 then '' else 'drug' || p_size end as b from part)"


def _role(role: str, phrases: str, first: bool):
    mine = f"case when phrase in ({phrases}) then b else '' end"
    return f"with {_TITLES} select p_partkey, " + (f"concat_ws('|', a, nullif({mine}, ''))" if first else mine) + " as drugs from titles"


def _by_role(spark: SparkSession, d: str, role: str) -> DataFrame:
    return titles(spark, d).select("p_partkey", F.array_join(U.by_role(F.col("title"), role), "|").alias("drugs"))


# Titles, and the drugs of each role in them: {a}, {b} and {c} are three names of the table.
_TITLE_EXAMPLES = (
    ("{a} as a single drug", "{a}", "", ""), ("{a} + {b}", "{a};;{b}", "", ""), ("{a} in combination with {b}", "{a};;{b}", "", ""), ("{a} and {b}", "{a};;{b}", "", ""), ("{a} combined with {b}", "{a};;{b}", "", ""),
    ("{a} alone and in combination with {b}", "{a};;{b}", "", ""), ("{a} monotherapy and in combination with {b}", "{a};;{b}", "", ""), ("{a} with {b}", "{a};;{b}", "", ""), ("{a} as a single agent and in combination with {b}", "{a};;{b}", "", ""),
    ("{a} given together with {b}", "{a};;{b}", "", ""), ("{a} in combo with {b}", "{a};;{b}", "", ""), ("{a} followed by {b}", "{a};;{b}", "", ""), ("{a} or {b}", "{a};;{b}", "", ""),
    ("{a} with or without {b}", "{a}", "{b}", ""), ("{a} ± {b}", "{a}", "{b}", ""), ("{a} alone or in combination with {b}", "{a}", "{b}", ""), ("{a} monotherapy and/or in combination with {b}", "{a}", "{b}", ""), ("{a} alone or with {b}", "{a}", "{b}", ""),
    ("{a} or in combination with {b}", "{a}", "{b}", ""), ("{a} as a single agent or in combination with {b}", "{a}", "{b}", ""), ("{a} monotherapy or in combination with {b}", "{a}", "{b}", ""), ("{a} and/or {b}", "{a}", "{b}", ""),
    ("{a} vs {b}", "{a}", "", "{b}"), ("{a} comparing to {b}", "{a}", "", "{b}"), ("{a} to compare with {b}", "{a}", "", "{b}"), ("{a} compared with {b}", "{a}", "", "{b}"), ("Comparing {a} and {b}", "{a}", "", "{b}"),
    ("{a} combined with {b} vs {a} monotherapy", "{a};;{b}", "", "{a}"), ("{a} vs {b} combined with {c}", "{a}", "", "{b};;{c}"), ("{a} 20 mg ± {b} versus oral {c}, a study", "{a}", "{b}", "{c}"), ("Placebo with or without {b}", "{b}", "", ""),
    ("{a} chemotherapy", "{a}", "", ""), ("{a} for patients previously treated with {b}", "{a}", "", ""), ("{a}, a type of {b}, for the treatment of CLL", "{a}", "", ""), ("placebo vs {c}", "{c}", "", ""), ("A study of chemotherapy", "", "", ""),
)


def _title_parts() -> str:
    cell = lambda k: f"replace(replace(replace([{', '.join(chr(39) + e[k] + chr(39) for e in _TITLE_EXAMPLES)}][p_partkey % {len(_TITLE_EXAMPLES)} + 1], '{{a}}', a), '{{b}}', b), '{{c}}', c)"
    names = "names as (select p_name, row_number() over (order by p_name) - 1 as i, count(*) over () as n from (select distinct p_name from part))"
    three = "three as (select p_partkey, x.p_name as a, y.p_name as b, z.p_name as c from part p join names x on x.i = p.p_partkey % x.n join names y on y.i = (p.p_partkey + 1) % y.n join names z on z.i = (p.p_partkey + 2) % z.n)"
    return f"with {names}, {three} select p_partkey, {cell(0)} as title, {cell(1)} as primary_drugs, {cell(2)} as secondary_drugs, {cell(3)} as comparator_drugs from three"


@query(_title_parts())
def r01_r05_title_roles(spark: SparkSession, d: str) -> DataFrame:
    """The roles of drugs in titles, with the names of the table as the dictionary of drugs."""
    part = V.table(spark, d, "part")
    names = R.numbered_rows(part.select("p_name").distinct(), ["p_name"], "i").withColumn("i", F.col("i") - 1)  # distinct names: a bounded list
    of = names.crossJoin(F.broadcast(names.agg(F.count("*").alias("n"))))  # one row
    rows = part.select("p_partkey", F.element_at(F.array(*[F.lit(e[0]) for e in _TITLE_EXAMPLES]), (F.col("p_partkey") % len(_TITLE_EXAMPLES) + 1).cast("int")).alias("title")).crossJoin(F.broadcast(names.agg(F.count("*").alias("n"))))
    for k, letter in enumerate("abc"):
        one = of.select(F.col("i").alias("at"), F.col("p_name").alias("name"))
        rows = rows.withColumn("at", (F.col("p_partkey") + k) % F.col("n")).join(one, "at").withColumn("title", F.replace("title", F.lit(f"{{{letter}}}"), F.col("name"))).drop("at", "name")
    found = P.roles(rows, "p_partkey", "title", P.dictionary(part, "p_name"))
    return rows.select("p_partkey", "title").join(found, "p_partkey").select("p_partkey", "title", *[T.listed(F.col(r)).alias(f"{r}_drugs") for r in ("primary", "secondary", "comparator")])


@query(_role("primary", "'plus', 'in combination with', 'and', 'followed by'", True))
def r01_primary_drugs(spark: SparkSession, d: str) -> DataFrame:
    return _by_role(spark, d, "primary")


@query(_role("secondary", "'with or without', '±', 'and/or'", False))
def r02_secondary_drugs(spark: SparkSession, d: str) -> DataFrame:
    return _by_role(spark, d, "secondary")


@query(_role("comparator", "'vs', 'compared with'", False))
def r03_comparator_drugs(spark: SparkSession, d: str) -> DataFrame:
    return _by_role(spark, d, "comparator")


@query("select p_partkey, case when p_size % 2 = 0 then p_name when p_size % 3 = 0 then p_brand else '' end as primary_drugs, case when p_size % 2 = 0 and p_size % 3 = 0 then p_brand else '' end as secondary_drugs from part")
def r04_promote_primary(spark: SparkSession, d: str) -> DataFrame:
    one = lambda c, name: F.when(c, F.array(name)).otherwise(F.array().cast("array<string>"))
    p, s = U.with_primary(one(F.col("p_size") % 2 == 0, "p_name"), one(F.col("p_size") % 3 == 0, "p_brand"))
    return V.table(spark, d, "part").select("p_partkey", F.array_join(p, "|").alias("primary_drugs"), F.array_join(s, "|").alias("secondary_drugs"))


@query("select p_partkey, concat_ws('|', case when p_size % 4 <> 0 then p_name end) as kept from part")
def r05_exclusions(spark: SparkSession, d: str) -> DataFrame:
    names = F.array(F.when(F.col("p_size") % 4 == 0, F.lit("NCT01234")).otherwise(F.col("p_name")), F.lit("Placebo"), F.lit("oral"))
    return V.table(spark, d, "part").select("p_partkey", F.array_join(U.kept_drugs(names), "|").alias("kept"))


@query("select p_partkey, case p_size % 3 when 0 then 'Autologous Stem Cell' when 1 then 'CAR-T Cell' else p_name end as cell from part")
def r06_cell_names(spark: SparkSession, d: str) -> DataFrame:
    name = F.when(F.col("p_size") % 3 == 0, "Autologous Stem Cell transplantation").when(F.col("p_size") % 3 == 1, "car-t cells").otherwise(F.col("p_name"))
    return V.table(spark, d, "part").select("p_partkey", U.cell_name(name).alias("cell"))


# Texts as sources write them, made of columns, and in SQL the class that the rules make of each.
def _sourced(spark: SparkSession, d: str) -> DataFrame:
    """p_partkey, p_size, p_name, text."""
    size, k = F.col("p_size").cast("string"), F.col("p_partkey") % 8
    text = (
        F.when(k == 0, F.concat(F.lit(" TG"), size, F.lit("  blockade "))).when(k == 1, F.concat(F.lit("anti-TG"), size, F.lit(" antibodies"))).when(k == 2, F.concat(F.lit("CD"), size, F.lit("/CD3-Targeted engagers")))
        .when(k == 3, F.concat(F.lower("p_type"), F.lit(" inhibitors"))).when(k == 4, F.lit("adc")).when(k == 5, F.concat("p_name", F.lit(" cells"))).when(k == 6, F.concat(F.lit("BM"), size, F.lit(" targeted therapy"))).otherwise(F.concat("p_name", F.lit(" bi-specific antibodies")))
    )
    return V.table(spark, d, "part").select("p_partkey", "p_size", "p_name", "p_type", text.alias("text"))


_TITLE = "array_to_string(list_transform(string_split({c}, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')"
_CLASS = f"""case p_partkey % 8 when 0 then 'TG' || p_size || ' Inhibitor' when 1 then 'TG' || p_size || '-Targeted Antibody' when 2 then case when p_size < 3 then 'CD' || p_size || '/CD3' else 'CD3/CD' || p_size end || '-Targeted Engager'
  when 3 then {_TITLE.format(c='p_type')} || ' Inhibitor' when 4 then 'Antibody Drug Conjugate' when 5 then {_TITLE.format(c='p_name')} || ' Cell Therapy' when 6 then 'BM' || p_size || '-Targeted Therapy' else {_TITLE.format(c='p_name')} || ' Bispecific Antibody' end"""


@query(f"select p_partkey, {_CLASS} as class from part")
def r07_class_format(spark: SparkSession, d: str) -> DataFrame:
    return _sourced(spark, d).select("p_partkey", U.class_name(F.col("text")).alias("class"))


@query("select p_partkey, p_size % 3 <> 0 as same_words, p_size % 3 <> 0 as same_modality from part")
def r07_r32_wording_kept(spark: SparkSession, d: str) -> DataFrame:
    """A class keeps the words and the modality of its text; a third of them are someone else's."""
    name = F.when(F.col("p_size") % 3 == 0, "Other Antagonist").otherwise(U.class_name(F.col("text")))
    return _sourced(spark, d).select("p_partkey", U.keeps_wording(name, F.col("text")).alias("same_words"), U.keeps_modality(name, F.col("text")).alias("same_modality"))


@query(f"""select p_partkey, case p_partkey % 7 when 0 then case when p_size < 3 then 'CD' || p_size || '/CD3' when p_size = 3 then 'CD3/CD3' else 'CD3/CD' || p_size end || '-Targeted Bispecific Antibody' when 1 then 'TRIKE' when 2 then {_TITLE.format(c='p_name')} || ' Agonist'
  when 3 then 'TIL Therapy' when 4 then '' when 5 then {_TITLE.format(c='p_type')} || ' Receptor Modulator' else {_TITLE.format(c='p_name')} || ' Antagonist;;Antibody Drug Conjugate' end as classes from part""")
def r15_r20_r26_r33_captured(spark: SparkSession, d: str) -> DataFrame:
    k, size = F.col("p_partkey") % 7, F.col("p_size").cast("string")
    text = (
        F.when(k == 0, F.concat(F.lit("Drug is a bi-specific antibody targeting CD"), size, F.lit(" and CD3"))).when(k == 1, F.lit("It is a TRIKE therapeutic")).when(k == 2, F.concat(F.lit("Drug is an "), "p_name", F.lit(" agonist")))
        .when(k == 3, F.lit("a tumor infiltrating lymphocyte therapy")).when(k == 4, F.concat(F.lit("patients previously treated with a "), "p_name", F.lit(" agonist"))).when(k == 5, F.concat(F.lit("the "), F.lower("p_type"), F.lit(" receptor modulators")))
        .otherwise(F.concat(F.lit("Drug is the "), "p_name", F.lit(" antagonist and an antibody drug conjugate")))
    )
    return V.table(spark, d, "part").select("p_partkey", T.listed(N.captured(text)).alias("classes"))


# Texts and the classes that the rules make of them; {d} is a name and {n} a number of a row.
_EXAMPLES = (
    ("flt3 inhibitor", "FLT3 Inhibitor"),
    ("PDL{n}-Inhibitor", "PDL{n}-Inhibitor"),
    ("PD-{n} Inhibitors", "PD-{n} Inhibitor"),
    ("{d} has two mechanisms: PD-{n} inhibitor and CTLA-{n} inhibitor.", "PD-{n} Inhibitor;;CTLA-{n} Inhibitor"),
    ("{d} is a cytolytic antibody.", "Cytolytic Antibody"),
    ("{d} is a monoclonal antibody.", "Monoclonal Antibody"),
    ("BM{n} targeted therapy", "BM{n}-Targeted Therapy"),
    ("BCR-ABL inhibitor", "BCR-ABL Inhibitor"),
    ("{d} is an anti-PD{n} antibody.", "PD{n}-Targeted Antibody"),
    ("anti-PD-{n} antibody", "PD-{n}-Targeted Antibody"),
    ("Anti-CD{n} monoclonal antibody", "CD{n}-Targeted Monoclonal Antibody"),
    ("{d} inhibits PDL{n}.", "PDL{n}-Inhibitor"),
    ("{d} is an AR-targeted PROTAC.", "AR-Targeted PROTAC"),
    ("{d} is a CD3/CD1{n} bispecific T cell engager.", "CD3/CD1{n}-Targeted Bispecific T-Cell Engager"),
    ("{d} is a PD-{n} blocker.", "PD-{n} Inhibitor"),
    ("{d} works through PD-{n} blockade.", "PD-{n} Inhibitor"),
    ("{d} is a BK virus inhibitor.", "BK Virus Inhibitor"),
    ("{d} is a CNS stimulant.", "CNS Stimulant"),
    ("{d} is a GLP-{n} agonist.", "GLP-{n} Agonist"),
    ("{d} is an EGFR antagonist.", "EGFR Antagonist"),
    ("{d} is a bispecific antibody targeting CD3 and CD1{n}.", "CD3/CD1{n}-Targeted Bispecific Antibody"),
    ("{d} is a trispecific antibody.", "Trispecific Antibody"),
    ("{d} is an immune checkpoint inhibitor.", "Immune Checkpoint Inhibitor"),
    ("{d} is an estrogen receptor modulator.", "Estrogen Receptor Modulator"),
    ("{d} is a PROTAC degrader targeting AR.", "AR Degrader"),
    ("{d} is a gene therapy for hemophilia.", "Gene Therapy"),
    ("{d} is used for androgen deprivation therapy.", "Hormonal Therapy"),
    ("Patient received ADT treatment.", "Hormonal Therapy"),
    ("{d} is a BIKE targeting CD3/CD19.", "CD3/CD19-Targeted BIKE"),
    ("{d} is a TRIKE therapeutic.", "TRIKE"),
    ("{d} is a SMITE molecule.", "SMITE"),
    ("{d} is a hypomethylating agent.", "Hypomethylating Agent"),
    ("{d} is 18F-FDG used for PET imaging.", "Diagnostic Imaging Agent"),
    ("{d} is 68Ga-PSMA for prostate cancer detection.", "Diagnostic Imaging Agent"),
    ("{d} is a radiotracer for cardiac imaging.", "Diagnostic Imaging Agent"),
    ("{d} is magnesium sulfate for seizure prevention.", "Mineral Supplement"),
    ("{d} is potassium chloride for hypokalemia.", "Mineral Supplement"),
    ("{d} is calcium gluconate.", "Mineral Supplement"),
    ("{d} is an mRNA vaccine.", "Vaccine"),
    ("{d} is a live attenuated vaccine.", "Vaccine"),
    ("{d} is a cancer vaccine.", "Vaccine"),
    ("{d} is a stem cell product.", "Stem Cell Therapy"),
    ("{d} uses autologous hematopoietic cells.", "Autologous Hematopoietic Cell Therapy"),
    ("{d} is an autologous hematopoietic stem cell therapy.", "Autologous Hematopoietic Stem Cell Therapy"),
    ("{d} is a CAR-T cell product.", "CAR-T Cell Therapy"),
    ("{d} is an NK cell therapy.", "NK Cell Therapy"),
    ("{d} uses dendritic cells.", "Dendritic Cell Therapy"),
    ("{d} is a TIL therapy.", "TIL Therapy"),
    ("{d} is an antibody drug conjugate.", "Antibody Drug Conjugate"),
    ("{d} is an exon skipping therapy.", "Exon Skipping Therapy"),
    ("{d} uses platelet-rich plasma.", "Plasma Therapy"),
    ("{d} is an anti-metabolite and DHFR inhibitor.", "DHFR Inhibitor"),
    ("{d} is a PD-L1 inhibitor", "PD-L1 Inhibitor"),
    ("Primary: Drug A (PD-{n} inhibitor) vs Comparator: Drug B (chemotherapy)", "PD-{n} Inhibitor"),
    ("{d} is a CD3/CD1{n}-targeted bispecific antibody.", "CD3/CD1{n}-Targeted Bispecific Antibody"),
    ("Antimicrobial Stewardship Program conference", "NA"),
    ("NSCLC patients previously treated with EGFR-Inhibitor", "NA"),
    ("EGFR-Inhibitor Related Cardiac Dysfunction", "NA"),
    ("Patient failed prior TKI therapy", "NA"),
    ("Patient received chemotherapy.", "NA"),
    ("Patient received immunotherapy.", "NA"),
    ("{d} is a targeted therapy.", "NA"),
    ("{d} is an antibody.", "NA"),
    ("{d} has anti-tumor activity.", "NA"),
    ("{d} is a small molecule.", "NA"),
    ("{d} is an antineoplastic agent.", "NA"),
    ("{d} treats breast cancer.", "NA"),
    ("{d} used in surgery.", "NA"),
    ("{d} affects cell proliferation.", "NA"),
    ("No mechanism information provided.", "NA"),
    ("{d} is used as adjuvant therapy.", "NA"),
    ("{d} is an ADC.", "Antibody Drug Conjugate"),
    ("{d} is an ICI.", "Immune Checkpoint Inhibitor"),
    ("{d} is a TKI.", "Tyrosine Kinase Inhibitor"),
    ("{d} is a BITE.", "Bispecific T-cell Engager"),
    ("{d} is an estrogen receptor antagonist; stops drug-induced nausea", "Estrogen Receptor Antagonist"),
    ("HER2-targeted ADC", "HER2-Targeted Antibody Drug Conjugate"),
    ("CD1{n}/CD3-targeted antibody", "CD3/CD1{n}-Targeted Antibody"),
    ("PD-L1/CTLA-4-targeted antibody", "CTLA-4/PD-L1-Targeted Antibody"),
    ("GLP-1/GIP receptor agonist", "GIP/GLP-1 Receptor Agonist"),
    ("a 4-1BB agonist, a zinc finger inhibitor", "4-1BB Agonist;;Zinc Finger Inhibitor"),
    ("a PD-{n} inhibitor is an immune checkpoint inhibitor", "PD-{n} Inhibitor"),
    ("Patients resistant to a BRAF inhibitor v1.2 received it. It is a MEK inhibitor", "MEK Inhibitor"),
    ("immune checkpoint inhibitor-related colitis, treated with a JAK{n} inhibitor", "JAK{n} Inhibitor"),
    ("calcium channel blocker", "Calcium Channel Inhibitor"),
    ("bite of an insect", "NA"),
    ("anti-inflammatory agent", "Anti-inflammatory Agent"),
)


def _filled(k: int) -> str:
    listed = "[" + ", ".join("'" + e[k].replace("'", "''") + "'" for e in _EXAMPLES) + "]"
    return f"replace(replace({listed}[p_partkey % {len(_EXAMPLES)} + 1], '{{d}}', p_name), '{{n}}', cast(p_size as varchar))"


@query(f"select p_partkey, {_filled(0)} as text, {_filled(1)} as classes from part")
def r03_r38_class_examples(spark: SparkSession, d: str) -> DataFrame:
    """The classes of texts by all rules together."""
    template = F.element_at(F.array(*[F.lit(t) for t, _ in _EXAMPLES]), (F.col("p_partkey") % len(_EXAMPLES) + 1).cast("int"))
    text = F.replace(F.replace(template, F.lit("{d}"), F.col("p_name")), F.lit("{n}"), F.col("p_size").cast("string"))
    return V.table(spark, d, "part").select("p_partkey", text.alias("text")).withColumn("classes", T.listed(N.classes_of(F.col("text"))))


@query("select p_partkey, case when p_size % 2 = 0 then p_brand || ' Inhibitor' when p_size % 3 = 0 then 'Immune Checkpoint Inhibitor' else 'Anti-Metabolite' end as classes from part")
def r17_r28_without_general(spark: SparkSession, d: str) -> DataFrame:
    names = F.array(F.lit("Anti-Metabolite"), F.when(F.col("p_size") % 3 == 0, "Immune Checkpoint Inhibitor"), F.when(F.col("p_size") % 2 == 0, F.concat("p_brand", F.lit(" Inhibitor"))))
    return V.table(spark, d, "part").select("p_partkey", T.listed(U.without_general(F.filter(names, lambda n: n.isNotNull()))).alias("classes"))


_SAID = ["18F-FDG for PET imaging of", "magnesium sulfate with", "mRNA vaccines for", "Platelet-Rich Plasma gel on", "patients on ADT and", "PD-1 inhibitor with", "irony and"]


def _said(spark: SparkSession, d: str) -> DataFrame:
    phrase = F.element_at(F.array(*[F.lit(o) for o in _SAID]), (F.col("p_partkey") % len(_SAID) + 1).cast("int"))
    return V.table(spark, d, "part").select("p_partkey", F.concat("p_name", F.lit(" "), phrase, F.lit(" "), F.lower("p_type")).alias("text"))


@query("with t as (select p_partkey, lower(p_name || ' ' || ([" + ", ".join(f"'{o}'" for o in _SAID) + f"])[p_partkey % {len(_SAID)} + 1] || ' ' || p_type) as t from part)"
  " select p_partkey, case when contains(t, 'pet imaging') or contains(t, 'diagnostic') or contains(t, '18f-') then 'Diagnostic Imaging Agent' when list_has_any(string_split(t, ' '), ['magnesium', 'calcium', 'potassium', 'zinc', 'iron']) then 'Mineral Supplement'"
  " when contains(t, ' vaccine') then 'Vaccine' when contains(t, 'platelet-rich plasma') then 'Plasma Therapy' when list_contains(string_split(t, ' '), 'adt') then 'Hormonal Therapy' else '' end as class from t")
def r08_overrides(spark: SparkSession, d: str) -> DataFrame:
    return _said(spark, d).select("p_partkey", T.or_empty(U.overridden(F.col("text"))).alias("class"))


@query("select p_partkey, case p_partkey % 3 when 0 then 'NA' when 1 then 'PD-1 Inhibitor' else 'Vaccine' end as classes from part")
def r09_generic_labels(spark: SparkSession, d: str) -> DataFrame:
    rows = V.table(spark, d, "part")
    extra = F.when(F.col("p_partkey") % 3 == 0, "adjuvant").when(F.col("p_partkey") % 3 == 1, "PD-1 blocker").otherwise("cancer vaccines")
    return rows.select("p_partkey", T.listed(U.classes(F.array(F.lit("chemotherapy"), F.lit("antibodies"), extra))).alias("classes"))


@query(V.sql("select distinct abstract_id, drug, drug_class, class_type from (select *, rank() over (partition by abstract_id order by case class_type when 'MoA' then 1 when 'Chemical' then 2 when 'Mode' then 3 else 4 end) as k from drugs) where k = 1", "drugs"))
def r10_class_priority(spark: SparkSession, d: str) -> DataFrame:
    return R.top_types(V.drugs(spark, d), ["abstract_id"], "class_type", U.CLASS_PRIORITY).select("abstract_id", "drug", "drug_class", "class_type").distinct()


@query(V.sql("+n as (select distinct abstract_id, drug_class from drugs) select * from n p where not exists (select 1 from n c where c.abstract_id = p.abstract_id and c.drug_class <> p.drug_class and contains(c.drug_class, p.drug_class))", "drugs"))
def r11_most_specific(spark: SparkSession, d: str) -> DataFrame:
    return R.without_parents(V.drugs(spark, d), ["abstract_id"], "drug_class")


@query(V.sql("""+e as (select distinct abstract_id, drug_class from drugs where class_type = 'MoA'), s as (select distinct abstract_id, drug_class from drugs where class_type <> 'MoA'),
  r as (select * from e where not exists (select 1 from s where s.abstract_id = e.abstract_id and contains(s.drug_class, e.drug_class)))
  select e.abstract_id, coalesce(string_agg(r.drug_class, ';;' order by r.drug_class), 'NA') as refined, coalesce(string_agg(e.drug_class, ';;' order by e.drug_class) filter (r.drug_class is null), '') as removed from e left join r using (abstract_id, drug_class) group by e.abstract_id""", "drugs"))
def r12_p17_consolidation(spark: SparkSession, d: str) -> DataFrame:
    rows = V.drugs(spark, d)
    explicit = rows.where("class_type = 'MoA'").select("abstract_id", "drug_class").distinct()
    chosen = rows.where("class_type <> 'MoA'").select(F.col("abstract_id").alias("s_id"), F.col("drug_class").alias("s_class")).distinct()
    hit = explicit.join(chosen, (F.col("abstract_id") == F.col("s_id")) & F.contains(F.col("s_class"), F.col("drug_class")), "left").groupBy("abstract_id", "drug_class").agg(F.count("s_id").alias("hits"))
    lists = hit.groupBy("abstract_id").agg(F.array_sort(F.collect_list(F.when(F.col("hits") == 0, F.col("drug_class")))).alias("r"), F.array_sort(F.collect_list(F.when(F.col("hits") > 0, F.col("drug_class")))).alias("x"))
    return lists.select("abstract_id", F.when(F.size("r") > 0, T.listed(F.col("r"))).otherwise("NA").alias("refined"), T.listed(F.col("x")).alias("removed"))


@query(V.sql("select distinct abstract_id, drug, drug_class from (select *, dense_rank() over (partition by abstract_id, drug order by case when severity = 'high' then 1 else 2 end) as k from drugs) where k = 1", "drugs"))
def r13_source_priority(spark: SparkSession, d: str) -> DataFrame:
    rows = V.drugs(spark, d).withColumn("source", F.when(F.col("severity") == "high", "title").otherwise("search"))
    return R.top_types(rows, ["abstract_id", "drug"], "source", {"title": 1, "search": 2}).select("abstract_id", "drug", "drug_class").distinct()


@query(V.sql("select abstract_id, case when regexp_matches(abstract_title, '(?i)ther') then 'abstract_title' when regexp_matches(session_title, 'src1') then 'session_title' else 'none' end as selected_source, case when regexp_matches(abstract_title, '(?i)ther') then abstract_title when regexp_matches(session_title, 'src1') then session_title else '' end as chosen from abstracts", "abstracts"))
def r14_single_source(spark: SparkSession, d: str) -> DataFrame:
    name, chosen = U.source_of(F.col("abstract_title"), F.col("session_title"), "(?i)ther|^src1")
    return V.abstracts(spark, d).select("abstract_id", name.alias("selected_source"), chosen.alias("chosen"))


@query(f"select p_partkey, {_TITLE.format(c='p_name')} || case when p_partkey % 3 = 2 then ' Cancer' else '' end as indication from part")
def r15_indication_format(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey") % 3
    text = F.when(k == 0, F.concat(F.lit("women "), "p_name", F.lit("s"))).when(k == 1, F.concat(F.lower("p_type"), F.lit("-induced  "), "p_name")).otherwise(F.concat("p_name", F.lit("  cancers ")))
    return V.table(spark, d, "part").select("p_partkey", U.indication(text).alias("indication"))


@query(V.sql("select abstract_id, case max(case severity when 'high' then 2 when 'medium' then 1 else 0 end) when 2 then 'FAIL' when 1 then 'REVIEW' else 'PASS' end as validation_status from drugs group by abstract_id", "drugs"))
def r16_severity_rollup(spark: SparkSession, d: str) -> DataFrame:
    rows = V.drugs(spark, d).withColumn("severity", F.when(F.col("severity") != "low", F.col("severity")))  # null: no issue
    return S.severity_status(rows, ["abstract_id"])


@query(V.sql("select abstract_id, contains(lower(full_abstract), lower(case when length(abstract_id) % 2 = 0 then session_title else split_part(abstract_title, ' ', 2) end)) as supported from abstracts", "abstracts"))
def r17_evidence_in_source(spark: SparkSession, d: str) -> DataFrame:
    return V.abstracts(spark, d).select("abstract_id", U.supported(F.when(F.length("abstract_id") % 2 == 0, F.col("session_title")).otherwise(F.split_part("abstract_title", F.lit(" "), F.lit(2))), F.col("full_abstract")).alias("supported"))


@query("select p_partkey, not regexp_matches(p_name || ([';;', ' ;;', ';', ', ', ';;  '])[p_partkey % 5 + 1] || p_type, '\\s;;|;;\\s|^\\s|\\s$|\\s\\s|[^;];[^;]|,') as well_formed from part")
def r18_format_check(spark: SparkSession, d: str) -> DataFrame:
    between = F.element_at(F.array(*[F.lit(x) for x in (";;", " ;;", ";", ", ", ";;  ")]), (F.col("p_partkey") % 5 + 1).cast("int"))
    return V.table(spark, d, "part").select("p_partkey", U.well_formed(F.concat("p_name", between, "p_type")).alias("well_formed"))


@query("select p_partkey, unnest(case p_partkey % 3 when 0 then ['Cyclophosphamide', 'Doxorubicin', 'Vincristine', 'Prednisone'] when 1 then ['Folinic Acid', 'Fluorouracil', 'Irinotecan'] else [p_name] end) as component from part")
def r19_l03_regimens(spark: SparkSession, d: str) -> DataFrame:
    drug = F.when(F.col("p_partkey") % 3 == 0, "chop").when(F.col("p_partkey") % 3 == 1, "FOLFIRI").otherwise(F.col("p_name"))
    return V.table(spark, d, "part").select("p_partkey", F.explode(U.parts_of(drug)).alias("component"))


@query("""with t as (select distinct p_brand, p_name from part where p_size % 2 = 0), r as (select p_brand, p_name, row_number() over (partition by p_brand order by p_name) as place from t)
  select p.p_partkey, case when p.p_partkey % 2 = 0 then coalesce(r.p_name, ' ' || lower(p.p_brand)) else p.p_name end as component, coalesce(r.place, 1) as place from part p left join r on p.p_partkey % 2 = 0 and r.p_brand = p.p_brand""")
def r19_regimen_table(spark: SparkSession, d: str) -> DataFrame:
    """Regimens by a table: a brand has its even-sized parts, in the order of their names, as components."""
    part = V.table(spark, d, "part")
    parts = part.where("p_size % 2 = 0").select("p_brand", "p_name").distinct()
    table = R.numbered_rows(parts, ["p_name"], "place", ["p_brand"]).select(F.col("p_brand").alias("regimen"), "place", F.col("p_name").alias("component"))
    asked = part.select("p_partkey", F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit(" "), F.lower("p_brand"))).otherwise(F.col("p_name")).alias("drug"))
    return U.components(asked, "drug", table).select("p_partkey", "component", F.col("place").cast("long").alias("place"))

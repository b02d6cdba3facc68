"""The warehouse built from the driver's test tables (role binding, SURVEY §7.3).

The test tables are not healthcare data, so each warehouse role is bound to a
test table and the real dimension / fact / mart / KPI code runs on it:

=====================  ===========================================================
role                   test table -> columns
=====================  ===========================================================
patient                customer: id = c_custkey, name = c_name, age = c_custkey mod 100,
                       sex = M for even keys else F, birth = 1940-01-01 + (key*7919 mod 20000) days
consultation           orders: num = o_orderkey, patient = o_custkey, date = o_orderdate,
                       motif = o_orderpriority, length = o_orderkey mod 45 minutes;
                       professional = smallest supplier of its lines, diagnosis = smallest part
hospitalisation        lineitem: num = (l_orderkey, l_linenumber), entry = l_shipdate,
                       days = l_quantity, establishment = l_suppkey, diagnosis = l_partkey
establishment          supplier: code = s_suppkey, name = s_name, department = nation name,
                       region = region name
professional           supplier (the establishment it belongs to is itself); specialty = its region
diagnosis              part: code = p_brand-p_partkey, label = p_name,
                       category = first letter of p_type + 2-digit p_size
insurer                distinct o_orderpriority
death registry         events: date = ts, person = user_id (same name / birth rules as patients,
                       'error' events are born one day later so they do not match), place = nation
survey                 lineitem per supplier and ship year: score = 1000 x mean discount,
                       responses = total quantity; establishment found by containment of the
                       9-digit zero-padded supplier key in the establishment name (J08)
=====================  ===========================================================

Every derived column is a deterministic Column expression of the test tables,
so the DuckDB oracle SQL in ``oracles.py`` can rebuild the same warehouse.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.functions import calendar as cal
from carelake.functions import rules
from carelake.operators.history import scd2_init
from carelake.operators.keys import pseudonymize, with_surrogate_key
from carelake.operators.match import containment_lookup
from carelake.session import pin

AS_OF = dt.datetime(2025, 1, 1)
CAL_START = dt.date(1995, 1, 1)
CAL_END = dt.date(2024, 12, 31)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def birth_of(key) -> F.Column:
    """Stand-in birth date of person ``key`` (covers every day incl. Feb 29)."""
    k = F.col(key) if isinstance(key, str) else key
    return F.date_add(F.lit(dt.date(1940, 1, 1)), F.pmod(k * 7919, F.lit(20000)).cast("int"))


def name_of(key) -> F.Column:
    """Customer-style name of a person key: 'Customer#' + 9-digit key."""
    k = F.col(key) if isinstance(key, str) else key
    return F.concat(F.lit("Customer#"), F.lpad(k.cast("string"), 9, "0"))


class BoundWarehouse:
    """Lazily built dimensions and facts over one test-data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, as_of=AS_OF,
                 cal_start=CAL_START, cal_end=CAL_END):
        self.spark, self.sf_dir, self.as_of = spark, sf_dir, as_of
        self.cal_start, self.cal_end = cal_start, cal_end
        self._memo: dict[str, DataFrame] = {}

    def t(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    def _m(self, key, build):
        if key not in self._memo:
            self._memo[key] = build()
        return self._memo[key]

    @staticmethod
    def _dim(base: DataFrame, sk: str, keys: list[str]) -> DataFrame:
        """A numbered dimension, stored: a plan over a stored table has its true size, so that Spark broadcasts a small one without
        shuffling the fact first; the numbering's own joins, planned again in each use, would hide it."""
        return pin(with_surrogate_key(base, sk, keys), sk)

    # --- dimensions -------------------------------------------------------------------

    def dim_temps(self) -> DataFrame:
        return self._m("dim_temps", lambda: cal.calendar(
            self.spark, self.cal_start, self.cal_end, self.cal_start.year, self.cal_end.year, as_of=self.as_of))

    def dim_patient(self) -> DataFrame:
        def build():
            c = self.t("customer")
            age = F.pmod(F.col("c_custkey"), F.lit(100)).cast("int")
            base = c.select(
                F.col("c_custkey").alias("id_patient"),
                pseudonymize("c_name").alias("nom_anonyme"),
                pseudonymize("c_mktsegment").alias("prenom_anonyme"),
                F.when(F.pmod(F.col("c_custkey"), F.lit(2)) == 0, "M").otherwise("F").alias("sexe"),
                birth_of("c_custkey").cast("timestamp").alias("date_naissance"),
                age.alias("age"), rules.age_band(age).alias("tranche_age"),
                F.col("c_nationkey").alias("code_lieu"))
            return self._dim(base, "sk_patient", ["id_patient"])
        return self._m("dim_patient", build)

    def _supplier_geo(self) -> DataFrame:
        s, n, r = self.t("supplier"), self.t("nation"), self.t("region")
        return (s.join(n, s.s_nationkey == n.n_nationkey, "left")
                .join(r, F.col("n_regionkey") == r.r_regionkey, "left"))

    def dim_etablissement(self) -> DataFrame:
        def build():
            g = self._supplier_geo()
            base = g.select(
                F.col("s_suppkey").cast("string").alias("finess"),
                F.col("s_suppkey").alias("id_etablissement"),
                F.col("s_name").alias("finess_site"),
                (F.col("s_suppkey") * 7919).cast("string").alias("finess_etablissement_juridique"),
                F.col("s_name").alias("nom_etablissement"),
                F.col("n_name").alias("departement"),
                F.col("r_name").alias("region"),
                rules.facility_type(F.col("s_name")).alias("type_etablissement"),
                rules.facility_sector(F.col("s_name")).alias("categorie"))
            return self._dim(base, "sk_etablissement", ["id_etablissement"])
        return self._m("dim_etablissement", build)

    def dim_diagnostic(self) -> DataFrame:
        def build():
            p = self.t("part")
            catg = F.concat(F.upper(F.substring("p_type", 1, 1)), F.lpad(F.col("p_size").cast("string"), 2, "0"))
            base = p.select(
                F.col("p_partkey").alias("id_diagnostic"),
                F.concat_ws("-", "p_brand", F.col("p_partkey").cast("string")).alias("code_diagnostic"),
                F.col("p_name").alias("libelle_diagnostic"),
                catg.alias("categorie_cim10"),
                rules.icd10_chapter(catg).alias("chapitre_cim10"))
            return self._dim(base, "sk_diagnostic", ["id_diagnostic"])
        return self._m("dim_diagnostic", build)

    def dim_specialite(self) -> DataFrame:
        def build():
            r = self.t("region")
            base = r.select(F.col("r_regionkey").alias("id_specialite"),
                            F.col("r_name").alias("code_specialite"),
                            F.lower("r_name").alias("fonction"), F.col("r_name").alias("specialite"),
                            rules.specialty_category(F.lower("r_name"), F.col("r_name")).alias("categorie"))
            return self._dim(base, "sk_specialite", ["id_specialite"])
        return self._m("dim_specialite", build)

    def dim_professionnel(self) -> DataFrame:
        def build():
            g = self._supplier_geo()
            spec = self.dim_specialite().select(F.col("id_specialite").alias("__reg"),
                                                F.col("sk_specialite").alias("fk_specialite"))
            etab = self.dim_etablissement().select(F.col("id_etablissement").alias("__sid"),
                                                   F.col("sk_etablissement").alias("fk_organisation"))
            base = (g.join(spec, g.n_regionkey == F.col("__reg"), "left")
                    .join(etab, g.s_suppkey == F.col("__sid"), "left")
                    .select(F.col("s_suppkey").cast("string").alias("identifiant"),
                            pseudonymize("s_name").alias("nom_anonyme"),
                            pseudonymize("n_name").alias("prenom_anonyme"),
                            F.col("n_name").alias("profession"), "fk_specialite", "fk_organisation"))
            keyed = self._dim(base, "sk_professionnel", ["identifiant"])
            return scd2_init(keyed, self.as_of.date())
        return self._m("dim_professionnel", build)

    def dim_mutuelle(self) -> DataFrame:
        def build():
            base = self.t("orders").select(F.col("o_orderpriority").alias("id_mut")).distinct()
            return self._dim(base, "sk_mutuelle", ["id_mut"])
        return self._m("dim_mutuelle", build)

    def dim_localisation(self) -> DataFrame:
        """M27 + M33: places (nations) seen by patients, establishments and deaths."""
        def build():
            n = self.t("nation")
            c = self.t("customer").select(F.col("c_nationkey").alias("k"), F.lit("Patient").alias("type_lieu"))
            s = self.t("supplier").select(F.col("s_nationkey").alias("k"), F.lit("Etablissement").alias("type_lieu"))
            e = (self.t("events").join(self.t("customer"), F.col("user_id") == F.col("c_custkey"))
                 .select(F.col("c_nationkey").alias("k"), F.lit("Deces").alias("type_lieu")))
            allp = c.union(s).union(e).distinct()
            places = (allp.groupBy("k").agg(F.array_join(F.array_sort(F.collect_set("type_lieu")), ", ")
                                           .alias("types_lieu"), F.count(F.lit(1)).alias("nb_occurrences"))
                      .join(n, F.col("k") == n.n_nationkey, "inner")
                      .join(self.t("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
                      .select(F.col("n_name").alias("code_lieu"), F.col("k").alias("id_lieu"), "types_lieu",
                              "nb_occurrences", F.col("n_name").alias("departement"),
                              F.col("r_name").alias("region")))
            return with_surrogate_key(places, "sk_localisation", ["code_lieu", "types_lieu"])
        return self._m("dim_localisation", build)

    # --- facts -----------------------------------------------------------------------

    def fait_hospitalisation(self) -> DataFrame:
        def build():
            li = self.t("lineitem")
            o = self.t("orders").select(F.col("o_orderkey").alias("__ok"), F.col("o_custkey").alias("__cust"))
            p = self.dim_patient().select(F.col("id_patient").alias("__pid"), "sk_patient")
            t = F.broadcast(self.dim_temps().select(F.col("date_complete").alias("__date"), "sk_temps"))
            e = self.dim_etablissement().select(F.col("id_etablissement").alias("__sid"), "sk_etablissement")
            d = self.dim_diagnostic().select(F.col("id_diagnostic").alias("__pk"), "sk_diagnostic")
            # the patients meet the orders, of which there are fewer than lines
            j = (li.join(o.join(p, F.col("__cust") == F.col("__pid"), "inner"), li.l_orderkey == F.col("__ok"), "inner")
                 .join(t, F.col("l_shipdate").cast("date") == F.col("__date"), "inner")
                 .join(e, li.l_suppkey == F.col("__sid"), "left")
                 .join(d, li.l_partkey == F.col("__pk"), "left"))
            return j.select(
                "sk_patient",
                F.coalesce("sk_etablissement", F.lit(-1)).cast("bigint").alias("sk_etablissement"),
                F.coalesce("sk_diagnostic", F.lit(-1)).cast("bigint").alias("sk_diagnostic"),
                "sk_temps",
                F.col("l_orderkey").alias("num_hospitalisation"), F.col("l_linenumber").alias("num_ligne"),
                F.col("l_quantity").cast("int").alias("jour_hospitalisation"),
                F.lit(1).alias("nombre_hospitalisations"))
        return self._m("fait_hospitalisation", build)

    def fait_consultation(self) -> DataFrame:
        def build():
            o = self.t("orders")
            lead = (self.t("lineitem").groupBy("l_orderkey")
                    .agg(F.min("l_suppkey").alias("__prof"), F.min("l_partkey").alias("__diag")))
            p = self.dim_patient().select(F.col("id_patient").alias("__pid"), "sk_patient")
            pr = self.dim_professionnel().where(F.col("est_actuel")).select(
                F.col("identifiant").alias("__prid"), "sk_professionnel", "fk_organisation")
            d = self.dim_diagnostic().select(F.col("id_diagnostic").alias("__pk"), "sk_diagnostic")
            t = F.broadcast(self.dim_temps().select(F.col("date_complete").alias("__date"), "sk_temps"))
            m = self.dim_mutuelle().select(F.col("id_mut").alias("__mut"), "sk_mutuelle")
            j = (o.join(lead, o.o_orderkey == lead.l_orderkey, "inner")
                 .join(p, o.o_custkey == F.col("__pid"), "inner")
                 .join(pr, F.col("__prof").cast("string") == F.col("__prid"), "inner")
                 .join(d, F.col("__diag") == F.col("__pk"), "inner")
                 .join(t, o.o_orderdate.cast("date") == F.col("__date"), "inner")
                 .join(m, o.o_orderpriority == F.col("__mut"), "left"))
            return j.select(
                "sk_patient", "sk_professionnel", "sk_diagnostic",
                F.coalesce("sk_mutuelle", F.lit(-1)).cast("bigint").alias("sk_mutuelle"),
                F.coalesce("fk_organisation", F.lit(-1)).cast("bigint").alias("sk_etablissement"),
                "sk_temps", F.col("o_orderkey").alias("num_consultation"),
                F.col("o_orderpriority").alias("motif"),
                F.pmod(F.col("o_orderkey"), F.lit(45)).cast("int").alias("duree_consultation"),
                F.lit(1).alias("nombre_consultations"))
        return self._m("fait_consultation", build)

    def fait_deces(self) -> DataFrame:
        def build():
            ev = self.t("events")
            cust = self.t("customer").select(F.col("c_custkey").alias("__ck"), F.col("c_nationkey").alias("__nat"),
                                             F.col("c_mktsegment").alias("__seg"))
            birth = F.when(F.col("event_type") == "error", F.date_add(birth_of("user_id"), 1)) \
                     .otherwise(birth_of("user_id"))
            d = (ev.join(cust, ev.user_id == F.col("__ck"), "left")
                 .select("event_id", "user_id", F.col("ts").cast("date").alias("date_deces"),
                         pseudonymize(name_of("user_id")).alias("__nom"),
                         pseudonymize(F.col("__seg")).alias("__prenom"),
                         birth.cast("timestamp").alias("__birth"), "__nat"))
            t = F.broadcast(self.dim_temps().select(F.col("date_complete").alias("__date"), "sk_temps"))
            loc = (self.dim_localisation().where(F.col("types_lieu").contains("Deces"))
                   .select(F.col("id_lieu").alias("__lieu"), "sk_localisation"))
            pat = self.dim_patient().select(F.col("nom_anonyme").alias("__pn"), F.col("prenom_anonyme").alias("__pp"),
                                            F.col("date_naissance").alias("__pb"), "sk_patient")
            j = (d.join(t, d.date_deces == F.col("__date"), "inner")
                 .join(loc, F.col("__nat") == F.col("__lieu"), "left")
                 .join(pat, (F.col("__nom") == F.col("__pn")) & (F.col("__prenom") == F.col("__pp")) & (F.col("__birth") == F.col("__pb")), "left"))
            return j.select(
                F.coalesce("sk_patient", F.lit(-1)).cast("bigint").alias("sk_patient"),
                F.coalesce("sk_localisation", F.lit(-1)).cast("bigint").alias("sk_localisation"),
                "sk_temps", F.col("event_id").alias("numero_acte_deces"), F.lit(1).alias("nombre_deces"))
        return self._m("fait_deces", build)

    def surveys(self) -> DataFrame:
        """ods_satisfaction_unifie stand-in: one row per supplier and ship year."""
        li = self.t("lineitem")
        return (li.groupBy("l_suppkey", F.year("l_shipdate").alias("annee_enquete"))
                .agg((F.avg("l_discount") * 1000).alias("score_global"),
                     F.sum("l_quantity").cast("bigint").alias("nombre_reponses"),
                     (F.avg("l_tax") * 1000).alias("taux_recommandation"))
                .select(F.lpad(F.col("l_suppkey").cast("string"), 9, "0").alias("finess"), "annee_enquete",
                        "score_global", "nombre_reponses", "taux_recommandation",
                        F.lit(None).cast("string").alias("region")))

    def fait_satisfaction(self) -> DataFrame:
        def build():
            s = self.surveys()
            found = containment_lookup(s, "finess", self.dim_etablissement(),
                                       ["finess_site", "finess", "finess_etablissement_juridique"],
                                       "sk_etablissement").withColumnRenamed("finess", "__needle")
            return (s.join(found, s.finess == F.col("__needle"), "left")
                    .select(F.coalesce("sk_etablissement", F.lit(-1)).cast("bigint").alias("sk_etablissement"),
                            "finess", "region", "annee_enquete", "score_global", "taux_recommandation",
                            "nombre_reponses"))
        return self._m("fait_satisfaction", build)

    # --- materialisation ----------------------------------------------------------------

    # tables in dependency levels: a level only reads tables of earlier levels
    DWH_LEVELS = [
        ["dim_temps", "dim_patient", "dim_etablissement", "dim_diagnostic", "dim_specialite", "dim_mutuelle",
         "dim_localisation"],
        ["dim_professionnel", "fait_hospitalisation", "fait_deces", "fait_satisfaction"],
        ["fait_consultation"],
    ]
    DWH_TABLES = [t for level in DWH_LEVELS for t in level]

    def materialize(self, root: str, parallel: int = 8) -> dict[str, str]:
        """Write every dimension and fact to ``<root>/dwh/<name>``, level by level.

        Later levels are built from the written tables (lineage cut at each table,
        as the reference materialises each model). Tables of one level are
        independent and are submitted as concurrent Spark jobs.
        """
        from concurrent.futures import ThreadPoolExecutor

        from carelake.sources.io import read_layer, write_layer
        paths = {}

        def build(name):
            df = getattr(self, name)()
            return name, write_layer(df, root, "dwh", name)

        for level in self.DWH_LEVELS:
            with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
                for name, path in pool.map(build, level):
                    paths[name] = path
            for name in level:
                self._memo[name] = read_layer(self.spark, root, "dwh", name)
        return paths

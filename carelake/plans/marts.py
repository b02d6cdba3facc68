"""Data marts (M41-M47): denormalised star joins and multi-grain aggregates.

The multi-grain marts re-attach group totals to every detail row (J11). A
window aggregate would need a ``count(distinct)`` inside a window, which Spark
does not plan, so each grain is a ``groupBy`` whose result (one row per group)
joins back on the group keys. Grains are computed from one base written once
as Parquet to the checkpoint folder (each grain reads only its columns).

The base holds keys, measures and the grains' own attributes; names and labels of the
dimensions join the rows last, after all grains, so that they travel in no grain's shuffle.
The finest grain, (day, establishment, diagnosis), has nearly as many groups as rows: its totals are
a window over rows already dealt by (day, establishment). All this relies on the fact keys
being non-NULL, which holds by construction: required keys come from inner
joins and optional keys are coalesced to the unknown member -1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.operators.joins import attach_totals
from carelake.operators.measures import avg_if, grain_totals, sum_if, totals_beside, weighted_mean
from carelake.session import pin


def _ts(as_of):
    return F.lit(as_of).cast("timestamp")


def dm_consultations_analysis(fc, d_temps, d_etab, d_diag, d_pro, d_spec, as_of) -> DataFrame:
    """Consultation fact denormalised over time, establishment, diagnosis,
    professional and (snowflake) specialty (J10, J09)."""
    t = F.broadcast(d_temps.select("sk_temps", "date_complete", "annee", "trimestre", "mois"))
    e = d_etab.select("sk_etablissement", "nom_etablissement", F.col("region").alias("region_etablissement"),
                      F.col("categorie").alias("type_etablissement"))
    d = d_diag.select("sk_diagnostic", "code_diagnostic", "libelle_diagnostic",
                      F.col("categorie_cim10").alias("categorie_diagnostic"))
    p = d_pro.select("sk_professionnel", "profession", F.col("fk_specialite").alias("__fk_spec"))
    s = d_spec.select(F.col("sk_specialite").alias("__sk_spec"), "specialite")
    j = (fc.join(t, "sk_temps", "left").join(e, "sk_etablissement", "left")
         .join(d, "sk_diagnostic", "left").join(p, "sk_professionnel", "left")
         .join(s, F.col("__fk_spec") == F.col("__sk_spec"), "left"))
    return j.select("sk_temps", "sk_etablissement", "sk_diagnostic", "sk_professionnel", "sk_patient",
                    "date_complete", "annee", "trimestre", "mois", "nom_etablissement",
                    "region_etablissement", "type_etablissement", "code_diagnostic", "libelle_diagnostic",
                    "categorie_diagnostic", "profession", "specialite", "nombre_consultations",
                    "duree_consultation", _ts(as_of).alias("date_chargement"))


def dm_hospitalisations_analysis(fh, d_temps, d_etab, d_diag, d_patient, as_of) -> DataFrame:
    """Stay fact denormalised over time, establishment, diagnosis, patient."""
    t = F.broadcast(d_temps.select("sk_temps", "date_complete", "annee", "trimestre", "mois"))
    e = d_etab.select("sk_etablissement", "nom_etablissement", F.col("region").alias("region_etablissement"))
    d = d_diag.select("sk_diagnostic", "code_diagnostic", "libelle_diagnostic")
    p = d_patient.select("sk_patient", "sexe", "tranche_age")
    j = (fh.join(t, "sk_temps", "left").join(e, "sk_etablissement", "left")
         .join(d, "sk_diagnostic", "left").join(p, "sk_patient", "left"))
    return j.select("sk_temps", "sk_etablissement", "sk_diagnostic", "sk_patient", "date_complete", "annee",
                    "trimestre", "mois", "nom_etablissement", "region_etablissement", "code_diagnostic",
                    "libelle_diagnostic", "sexe", "tranche_age", "nombre_hospitalisations",
                    "jour_hospitalisation", _ts(as_of).alias("date_chargement"))


def dm_deces_analysis(fd, d_temps, d_loc, as_of, year: int = 2019) -> DataFrame:
    """Deaths per day x region x department for one year.

    The year filter sits on the calendar side, so only that year's days reach the join.
    """
    t = F.broadcast(d_temps.where(F.col("annee") == year)
                    .select("sk_temps", "annee", "trimestre", "mois", "date_complete"))
    loc = d_loc.where(F.col("region").isNotNull() & (F.col("region") != "Non renseigne")) \
               .select("sk_localisation", "region", "departement")
    j = fd.join(t, "sk_temps", "inner").join(loc, "sk_localisation", "inner")
    return (j.groupBy("sk_temps", "annee", "trimestre", "mois", "date_complete", "region", "departement")
            .agg(F.sum("nombre_deces").cast("bigint").alias("nb_deces_departement"))
            .withColumn("date_chargement", _ts(as_of)))


def dm_satisfaction_analysis(fs, d_etab, as_of, year: int = 2020) -> DataFrame:
    """Survey per region for one year; weighted mean keeps NULL-score weights."""
    e = d_etab.select("sk_etablissement", F.col("region").alias("__region_e"), "nom_etablissement")
    region = F.coalesce(F.col("region"), F.col("__region_e"))
    base = (fs.where(F.col("annee_enquete") == year).join(e, "sk_etablissement", "left")
            .withColumn("__region", region)
            .where(F.col("__region").isNotNull() & (F.col("__region") != "Non renseigne")))
    agg = base.groupBy(F.col("__region").alias("region")).agg(
        F.count_distinct("sk_etablissement").alias("nb_etablissements_region"),
        F.sum("nombre_reponses").cast("bigint").alias("nb_reponses_totales_region"),
        weighted_mean("score_global", "nombre_reponses").alias("taux_satisfaction_moyen_region"),
        weighted_mean("taux_recommandation", "nombre_reponses").alias("taux_recommandation_moyen_region"),
        F.min("score_global").alias("note_min_region"),
        F.max("score_global").alias("note_max_region"),
        F.avg("score_global").alias("note_moyenne_simple_region"))
    return agg.select(F.lit(year * 10000 + 101).cast("bigint").alias("sk_temps"),
                      F.lit(year).alias("annee"), F.lit(1).alias("trimestre"), F.lit(1).alias("mois"),
                      F.make_date(F.lit(year), F.lit(1), F.lit(1)).alias("date_complete"),
                      "region", "nb_etablissements_region", "nb_reponses_totales_region",
                      "taux_satisfaction_moyen_region", "taux_recommandation_moyen_region",
                      "note_min_region", "note_max_region", "note_moyenne_simple_region",
                      _ts(as_of).alias("date_chargement"))


def _pin(base: DataFrame) -> DataFrame:
    """Write the shared base once as Parquet to the cluster's checkpoint folder:
    every grain and the final re-attachment read it instead of recomputing the
    star join, each grain scans only the columns it aggregates, and the lineage
    is cut so a lost executor does not replay the whole chain."""
    return pin(base, "mart-base")


def dm_consultations_agregees(fc, d_temps, d_etab, d_diag, d_pro, d_spec, d_patient, as_of) -> DataFrame:
    """Consultation detail + establishment, diagnosis, professional and
    patient-profile totals for the same day (A11, J11).

    The profile grain is (day, sex, age band, age) and is re-attached on all four
    keys. The reference re-attaches it on sex and band only, which repeats every
    detail row once per distinct age of its group (T17c); that pairing is not
    reproduced: each detail row carries the totals of its own profile.
    """
    t = F.broadcast(d_temps.select("sk_temps", "date_complete", "annee", "trimestre", "mois"))
    e = d_etab.select("sk_etablissement", "nom_etablissement",
                      F.col("region").alias("region_etablissement"),
                      F.col("departement").alias("departement_etablissement"))
    d = d_diag.select("sk_diagnostic", "code_diagnostic", "libelle_diagnostic", "chapitre_cim10",
                      "categorie_cim10")
    pr = d_pro.where(F.col("est_actuel")).select(
        "sk_professionnel", F.col("nom_anonyme").alias("nom_professionnel"),
        F.col("prenom_anonyme").alias("prenom_professionnel"), F.col("fk_specialite").alias("__fk_spec"))
    s = d_spec.select(F.col("sk_specialite").alias("__sk_spec"), "specialite", "fonction")
    pa = d_patient.select("sk_patient", "sexe", "tranche_age", "age")
    base = (fc.join(pr, "sk_professionnel", "left_semi")
            .join(pa, "sk_patient", "left")
            .select("sk_temps", "sk_etablissement", "sk_diagnostic", "sk_professionnel", "sexe", "tranche_age", "age", "sk_patient",
                    "nombre_consultations", "duree_consultation"))
    base = _pin(base)
    n, dur = F.col("nombre_consultations"), F.col("duree_consultation")

    def names(suffix):
        return [f"nb_consultations_{suffix}", f"duree_totale_{suffix}", f"nb_patients_uniques_{suffix}"]

    prof_keys = ["sk_temps", "sexe", "tranche_age", "age"]
    grains = grain_totals(base, {
        "etablissement": ["sk_temps", "sk_etablissement"], "professionnel": ["sk_temps", "sk_professionnel"], "profil": prof_keys},
        [F.sum(n).alias("nb_consultations"), F.sum(dur).alias("duree_totale")], ("sk_patient", "nb_patients_uniques"))
    g_etab, g_pro, g_prof = (
        grains[g].withColumnsRenamed({c: f"{c}_{g}" for c in ("nb_consultations", "duree_totale", "nb_patients_uniques")})
        for g in ("etablissement", "professionnel", "profil"))
    g_prof = g_prof.where((F.col("sexe") != "I") & (F.col("tranche_age") != "Non renseigne"))
    out = attach_totals(base, g_prof, prof_keys, names("profil"))
    out = attach_totals(out, g_pro, ["sk_temps", "sk_professionnel"], names("professionnel"))
    out = attach_totals(out, g_etab, ["sk_temps", "sk_etablissement"], names("etablissement"))
    out = totals_beside(out, ["sk_temps", "sk_etablissement", "sk_diagnostic"],
                        {"nb_consultations_diagnostic": F.sum(n), "duree_totale_diagnostic": F.sum(dur)},
                        ("sk_patient", "nb_patients_uniques_diagnostic"))
    out = out.drop("sk_patient", "nombre_consultations", "duree_consultation")
    out = (out.join(d, "sk_diagnostic", "left").join(pr, "sk_professionnel", "inner")
           .join(s, F.col("__fk_spec") == F.col("__sk_spec"), "left")
           .join(e, "sk_etablissement", "left").join(t, "sk_temps", "left"))
    return out.select("sk_temps", "date_complete", "annee", "trimestre", "mois", "sk_etablissement",
                      "nom_etablissement", "region_etablissement", "departement_etablissement",
                      "sk_diagnostic", "code_diagnostic", "libelle_diagnostic", "chapitre_cim10",
                      "categorie_cim10", "sk_professionnel", "nom_professionnel", "prenom_professionnel",
                      "specialite", "fonction", "sexe", "tranche_age", "age",
                      *names("etablissement"), *names("diagnostic"), *names("professionnel"), *names("profil"),
                      _ts(as_of).alias("date_chargement"))


def dm_hospitalisations_agregees(fh, d_temps, d_etab, d_diag, d_patient, as_of) -> DataFrame:
    """Stay detail + establishment, diagnosis, profile and region totals.

    Profile totals are re-attached on (day, sex, band, age), see M45 (T17c).
    """
    t = F.broadcast(d_temps.select("sk_temps", "date_complete", "annee", "trimestre", "mois"))
    e = d_etab.select("sk_etablissement", "nom_etablissement", F.col("region").alias("region_etablissement"),
                      F.col("departement").alias("departement_etablissement"))
    d = d_diag.select("sk_diagnostic", "code_diagnostic", "libelle_diagnostic", "chapitre_cim10",
                      "categorie_cim10")
    pa = d_patient.select("sk_patient", "sexe", "tranche_age", "age")
    base = (fh.join(e.select("sk_etablissement", "region_etablissement"), "sk_etablissement", "left").join(pa, "sk_patient", "left")
            .select("sk_temps", "sk_etablissement", "region_etablissement", "sk_diagnostic", "sexe", "tranche_age", "age", "sk_patient",
                    "nombre_hospitalisations", "jour_hospitalisation"))
    base = _pin(base)
    n, days = F.col("nombre_hospitalisations"), F.col("jour_hospitalisation")

    # a mean travels as its count: the doubles of four means would be a third of each shuffled row
    def parts(suffix):
        return [f"nb_hospitalisations_{suffix}", f"duree_totale_{suffix}", f"nb_patients_uniques_{suffix}", f"__nb_duree_{suffix}"]

    def measures(suffix):
        *sums, count = parts(suffix)
        mean = F.col(f"duree_totale_{suffix}").cast("double") / F.nullif(F.col(count), F.lit(0))
        return [*sums, F.coalesce(mean, F.lit(0)).alias(f"duree_moyenne_{suffix}")]

    # totals of (day, region), at most days of the calendar x regions, are broadcast once the rows have their region again
    prof_keys = ["sk_temps", "sexe", "tranche_age", "age"]
    grains = grain_totals(base, {
        "etablissement": ["sk_temps", "sk_etablissement", "region_etablissement"], "profil": prof_keys,
        "region": ["sk_temps", "region_etablissement"]},
        [F.sum(n).alias("nb_hospitalisations"), F.sum(days).alias("duree_totale"), F.count(days).alias("__nb_duree")],
        ("sk_patient", "nb_patients_uniques"))
    g_etab, g_prof, g_reg = (
        grains[g].withColumnsRenamed({c: f"{c}_{g}" for c in ("nb_hospitalisations", "duree_totale", "nb_patients_uniques",
                                                              "__nb_duree")})
        for g in ("etablissement", "profil", "region"))
    g_prof = g_prof.where((F.col("sexe") != "I") & (F.col("tranche_age") != "Non renseigne"))
    g_reg = g_reg.where(F.col("region_etablissement").isNotNull() & (F.col("region_etablissement") != "Non renseigne"))
    out = attach_totals(base.drop("region_etablissement"), g_prof, prof_keys, parts("profil"))
    out = attach_totals(out, g_etab.drop("region_etablissement"), ["sk_temps", "sk_etablissement"],
                        parts("etablissement"))
    out = totals_beside(out, ["sk_temps", "sk_etablissement", "sk_diagnostic"],
                        {"nb_hospitalisations_diagnostic": F.sum(n), "duree_totale_diagnostic": F.sum(days),
                         "__nb_duree_diagnostic": F.count(days)}, ("sk_patient", "nb_patients_uniques_diagnostic"))
    out = out.drop("sk_patient", "nombre_hospitalisations", "jour_hospitalisation")
    out = out.join(d, "sk_diagnostic", "left").join(e, "sk_etablissement", "left").join(t, "sk_temps", "left")
    out = attach_totals(out, F.broadcast(g_reg), ["sk_temps", "region_etablissement"], parts("region"))
    return out.select("sk_temps", "date_complete", "annee", "trimestre", "mois", "sk_etablissement",
                      "nom_etablissement", "region_etablissement", "departement_etablissement",
                      "sk_diagnostic", "code_diagnostic", "libelle_diagnostic", "chapitre_cim10",
                      "categorie_cim10", "sexe", "tranche_age", "age",
                      *measures("etablissement"), *measures("diagnostic"), *measures("profil"), *measures("region"),
                      _ts(as_of).alias("date_chargement"))


def dm_analyse_territoriale(fd, fs, d_temps, d_loc, d_patient, d_etab, as_of) -> DataFrame:
    """Deaths and satisfaction per day x region, merged by a full outer join.

    Survey facts have no day key; their day is January 1st of the survey year (T19).
    """
    t = F.broadcast(d_temps.select("sk_temps", "date_complete", "annee", "trimestre", "mois"))
    loc = d_loc.select("sk_localisation", "region")
    pa = d_patient.select("sk_patient", "sexe", "tranche_age")
    deaths = (fd.join(t, "sk_temps", "left").join(loc, "sk_localisation", "left").join(pa, "sk_patient", "left")
              .where(F.col("region").isNotNull() & (F.col("region") != "Non renseigne")))
    n = F.col("nombre_deces")
    dr = deaths.groupBy("sk_temps", "region", "annee", "trimestre", "mois", "date_complete").agg(
        F.sum(n).alias("nb_deces_region"),
        F.count_distinct("sk_patient").alias("nb_patients_deces_region"),
        sum_if(n, F.col("sexe") == "M").alias("nb_deces_hommes"),
        sum_if(n, F.col("sexe") == "F").alias("nb_deces_femmes"),
        sum_if(n, F.col("tranche_age") == "0-18").alias("nb_deces_0_18"),
        sum_if(n, F.col("tranche_age") == "19-30").alias("nb_deces_19_30"),
        sum_if(n, F.col("tranche_age") == "31-50").alias("nb_deces_31_50"),
        sum_if(n, F.col("tranche_age") == "51-65").alias("nb_deces_51_65"),
        sum_if(n, F.col("tranche_age") == "66+").alias("nb_deces_66_plus"))
    e = d_etab.select("sk_etablissement", F.col("region").alias("region_etablissement"))
    sat = (fs.withColumn("sk_temps", (F.col("annee_enquete") * 10000 + 101).cast("bigint"))
           .join(t, "sk_temps", "left").join(e, "sk_etablissement", "left")
           .where(F.col("region_etablissement").isNotNull()
                  & (F.col("region_etablissement") != "Non renseigne"))
           .withColumn("sexe", F.lit("I")))
    sr = sat.groupBy("sk_temps", "region_etablissement", "annee", "trimestre", "mois", "date_complete").agg(
        F.sum("nombre_reponses").alias("nb_reponses_satisfaction"),
        F.avg("score_global").alias("note_moyenne_satisfaction"),
        F.count_distinct("sk_etablissement").alias("nb_etablissements_satisfaction"),
        sum_if("nombre_reponses", F.col("sexe") == "M").alias("nb_reponses_hommes"),
        sum_if("nombre_reponses", F.col("sexe") == "F").alias("nb_reponses_femmes"),
        avg_if("score_global", F.col("sexe") == "M").alias("note_moyenne_hommes"),
        avg_if("score_global", F.col("sexe") == "F").alias("note_moyenne_femmes"))
    a, b = dr.alias("a"), sr.alias("b")
    j = a.join(b, (F.col("a.sk_temps") == F.col("b.sk_temps"))
               & (F.col("a.region") == F.col("b.region_etablissement")), "full_outer")

    def z(c):
        return F.coalesce(F.col(c), F.lit(0))

    return j.select(
        F.coalesce("a.sk_temps", "b.sk_temps").alias("sk_temps"),
        F.coalesce("a.date_complete", "b.date_complete").alias("date_complete"),
        F.coalesce("a.annee", "b.annee").alias("annee"),
        F.coalesce("a.trimestre", "b.trimestre").alias("trimestre"),
        F.coalesce("a.mois", "b.mois").alias("mois"),
        F.coalesce("a.region", "b.region_etablissement").alias("region"),
        *[z(f"a.{c}").alias(c) for c in ["nb_deces_region", "nb_patients_deces_region", "nb_deces_hommes",
                                          "nb_deces_femmes", "nb_deces_0_18", "nb_deces_19_30",
                                          "nb_deces_31_50", "nb_deces_51_65", "nb_deces_66_plus"]],
        z("b.nb_reponses_satisfaction").alias("nb_reponses_satisfaction"),
        z("b.note_moyenne_satisfaction").alias("note_moyenne_satisfaction"),
        F.lit(0).alias("nb_patients_satisfaction"),
        *[z(f"b.{c}").alias(c) for c in ["nb_etablissements_satisfaction", "nb_reponses_hommes",
                                          "nb_reponses_femmes", "note_moyenne_hommes",
                                          "note_moyenne_femmes"]],
        _ts(as_of).alias("date_chargement"))

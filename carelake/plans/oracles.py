"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Written in plain SQL the way the reference expresses each model: ``LIKE`` rule
chains, ``row_number() over (order by ...)`` keys, correlated ``min`` lookups for
the containment join, the documented fact-to-fact join for K10. Outputs are
cast to the types the Spark side produces (T12); double columns are rounded
to 6 digits on both sides by the entry point.
"""

from __future__ import annotations

from carelake.functions import rules as R
from carelake.functions.calendar import EASTER_OFFSETS, FIXED_HOLIDAYS


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def like_rules(text: str, rules, default: str, extra: dict | None = None) -> str:
    extra = extra or {}
    parts = []
    for label, alternatives in rules:
        cond = " OR ".join("(" + " AND ".join(f"{text} LIKE {q('%' + s + '%')}" for s in conj) + ")"
                           for conj in alternatives)
        if label in extra:
            cond = f"({cond}) AND {extra[label]}"
        parts.append(f"WHEN {cond} THEN {q(label)}")
    return "CASE " + " ".join(parts) + f" ELSE {q(default)} END"


def specialty_sql(fonction: str, specialite: str) -> str:
    return like_rules(f"lower({fonction})", R.SPECIALTY_RULES, R.SPECIALTY_DEFAULT,
                      {"Medecine specialisee": f"{specialite} IS NOT NULL AND trim({specialite}) != ''"})


def icd_sql(cat: str) -> str:
    parts = [f"WHEN {cat} BETWEEN {q(lo)} AND {q(hi)} THEN {q(label)}" for lo, hi, label in R.ICD10_CHAPTERS]
    return "CASE " + " ".join(parts) + f" ELSE {q(R.ICD10_DEFAULT)} END"


def region_sql(dept: str) -> str:
    parts = [f"WHEN {dept} IN ({', '.join(q(d) for d in ds)}) THEN {q(region)}"
             for region, ds in R.REGION_DEPARTMENTS]
    return "CASE " + " ".join(parts) + f" ELSE {q(R.REGION_DEFAULT)} END"


def age_band_sql(a: str) -> str:
    return (f"CASE WHEN {a} < 18 THEN '0-18' WHEN {a} BETWEEN 19 AND 30 THEN '19-30' "
            f"WHEN {a} BETWEEN 31 AND 50 THEN '31-50' WHEN {a} BETWEEN 51 AND 65 THEN '51-65' ELSE '66+' END")


def dept_sql(cp: str) -> str:
    t = f"trim({cp})"
    return (f"CASE WHEN substring({t}, 1, 2) = '20' AND length({t}) >= 3 THEN "
            f"CASE WHEN TRY_CAST(substring({t}, 3, 1) AS INTEGER) < 2 THEN '2A' ELSE '2B' END "
            f"WHEN length({t}) >= 2 THEN substring({t}, 1, 2) ELSE NULL END")


DAYS = "[" + ", ".join(q(d) for d in R.DAY_NAMES) + "]"
MONTHS = "[" + ", ".join(q(m) for m in R.MONTH_NAMES) + "]"


def calendar_ctes(days_sql: str, years_sql: str) -> str:
    """CTEs ``holidays`` and ``dim_temps`` from a day set (column d) and a year set (column y)."""
    fixed = ", ".join(f"({m}, {d}, {q(n)})" for m, d, n in FIXED_HOLIDAYS)
    movable = ", ".join(f"({o}, {q(n)})" for o, n in EASTER_OFFSETS)
    return f"""
cal_days AS ({days_sql}),
hol_years AS ({years_sql}),
hol_fixed AS (SELECT make_date(y, v.m, v.dd) AS date_ferie, v.n AS nom_ferie
              FROM hol_years, (VALUES {fixed}) v(m, dd, n)),
e1 AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM hol_years),
e2 AS (SELECT *, b // 4 AS d4, b % 4 AS e4, (b + 8) // 25 AS f FROM e1),
e3 AS (SELECT *, (b - f + 1) // 3 AS g FROM e2),
e4 AS (SELECT *, (19 * a + b - d4 - g + 15) % 30 AS h, c // 4 AS i, c % 4 AS k FROM e3),
e5 AS (SELECT *, (32 + 2 * e4 + 2 * i - h - k) % 7 AS l FROM e4),
e6 AS (SELECT *, (a + 11 * h + 22 * l) // 451 AS m FROM e5),
easter AS (SELECT make_date(y, CAST((h + l - 7 * m + 114) // 31 AS INTEGER),
                            CAST((h + l - 7 * m + 114) % 31 + 1 AS INTEGER)) AS es FROM e6),
hol_mov AS (SELECT CAST(es + v.o AS DATE) AS date_ferie, v.n AS nom_ferie
            FROM easter, (VALUES {movable}) v(o, n)),
holidays AS (SELECT * FROM hol_fixed UNION ALL SELECT * FROM hol_mov),
hol_day AS (SELECT date_ferie, min(nom_ferie) AS nom_ferie FROM holidays GROUP BY date_ferie),
dim_temps AS (
  SELECT CAST(strftime(c.d, '%Y%m%d') AS BIGINT) AS sk_temps, c.d AS date_complete,
         CAST(day(c.d) AS INTEGER) AS jour, CAST(month(c.d) AS INTEGER) AS mois,
         CAST(ceil(month(c.d) / 3.0) AS INTEGER) AS trimestre, CAST(ceil(month(c.d) / 6.0) AS INTEGER) AS semestre,
         CAST(year(c.d) AS INTEGER) AS annee, CAST(weekofyear(c.d) AS INTEGER) AS semaine_annee,
         CAST(isodow(c.d) AS INTEGER) AS jour_semaine,
         {DAYS}[isodow(c.d)] AS nom_jour, {MONTHS}[month(c.d)] AS nom_mois,
         isodow(c.d) IN (6, 7) AS est_weekend, h.date_ferie IS NOT NULL AS est_ferie,
         CASE WHEN month(c.d) IN (3, 4, 5) THEN 'Printemps' WHEN month(c.d) IN (6, 7, 8) THEN 'Ete'
              WHEN month(c.d) IN (9, 10, 11) THEN 'Automne' ELSE 'Hiver' END AS saison
  FROM cal_days c LEFT JOIN hol_day h ON c.d = h.date_ferie)"""


def _birth(key: str, plus: str = "0") -> str:
    return f"CAST(DATE '1940-01-01' + CAST(({key} * 7919) % 20000 AS INTEGER) + {plus} AS TIMESTAMP)"


def warehouse_ctes(cal_start="1995-01-01", cal_end="2024-12-31") -> str:
    """The bound warehouse (see ``bound.py``) as CTEs."""
    cal = calendar_ctes(
        f"SELECT CAST(unnest(generate_series(DATE '{cal_start}', DATE '{cal_end}', INTERVAL 1 DAY)) AS DATE) AS d",
        f"SELECT CAST(unnest(range({cal_start[:4]}, {int(cal_end[:4]) + 1})) AS INTEGER) AS y")
    ftype = like_rules("upper(s_name)", R.FACILITY_TYPE_RULES, R.FACILITY_TYPE_DEFAULT)
    fsector = like_rules("upper(s_name)", R.FACILITY_SECTOR_RULES, R.FACILITY_SECTOR_DEFAULT)
    catg = "upper(substring(p_type, 1, 1)) || lpad(CAST(p_size AS VARCHAR), 2, '0')"
    return cal + f""",
dim_patient AS (
  SELECT row_number() OVER (ORDER BY c_custkey) AS sk_patient, c_custkey AS id_patient,
         substring(sha256(c_name), 1, 8) AS nom_anonyme, substring(sha256(c_mktsegment), 1, 8) AS prenom_anonyme,
         CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS sexe, {_birth('c_custkey')} AS date_naissance,
         CAST(c_custkey % 100 AS INTEGER) AS age, {age_band_sql('CAST(c_custkey % 100 AS INTEGER)')} AS tranche_age,
         c_nationkey AS code_lieu
  FROM customer),
sup_geo AS (SELECT * FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
            LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
dim_etablissement AS (
  SELECT row_number() OVER (ORDER BY s_suppkey) AS sk_etablissement, CAST(s_suppkey AS VARCHAR) AS finess,
         s_suppkey AS id_etablissement, s_name AS finess_site,
         CAST(s_suppkey * 7919 AS VARCHAR) AS finess_etablissement_juridique, s_name AS nom_etablissement,
         n_name AS departement, r_name AS region, {ftype} AS type_etablissement, {fsector} AS categorie
  FROM sup_geo),
dim_diagnostic AS (
  SELECT row_number() OVER (ORDER BY p_partkey) AS sk_diagnostic, p_partkey AS id_diagnostic,
         concat_ws('-', p_brand, CAST(p_partkey AS VARCHAR)) AS code_diagnostic, p_name AS libelle_diagnostic,
         {catg} AS categorie_cim10, {icd_sql(catg)} AS chapitre_cim10
  FROM part),
dim_specialite AS (
  SELECT row_number() OVER (ORDER BY r_regionkey) AS sk_specialite, r_regionkey AS id_specialite,
         r_name AS code_specialite, lower(r_name) AS fonction, r_name AS specialite,
         {specialty_sql('lower(r_name)', 'r_name')} AS categorie
  FROM region),
dim_professionnel AS (
  SELECT row_number() OVER (ORDER BY CAST(g.s_suppkey AS VARCHAR)) AS sk_professionnel,
         CAST(g.s_suppkey AS VARCHAR) AS identifiant, substring(sha256(g.s_name), 1, 8) AS nom_anonyme,
         substring(sha256(g.n_name), 1, 8) AS prenom_anonyme, g.n_name AS profession,
         ds.sk_specialite AS fk_specialite, de.sk_etablissement AS fk_organisation, true AS est_actuel
  FROM sup_geo g LEFT JOIN dim_specialite ds ON g.n_regionkey = ds.id_specialite
       LEFT JOIN dim_etablissement de ON g.s_suppkey = de.id_etablissement),
dim_mutuelle AS (
  SELECT row_number() OVER (ORDER BY id_mut) AS sk_mutuelle, id_mut
  FROM (SELECT DISTINCT o_orderpriority AS id_mut FROM orders)),
loc_src AS (SELECT DISTINCT k, type_lieu FROM (
  SELECT c_nationkey AS k, 'Patient' AS type_lieu FROM customer
  UNION ALL SELECT s_nationkey, 'Etablissement' FROM supplier
  UNION ALL SELECT c.c_nationkey, 'Deces' FROM events e JOIN customer c ON e.user_id = c.c_custkey)),
loc_agg AS (SELECT k, string_agg(type_lieu, ', ' ORDER BY type_lieu) AS types_lieu, count(*) AS nb_occurrences
            FROM loc_src GROUP BY k),
dim_localisation AS (
  SELECT row_number() OVER (ORDER BY n.n_name, la.types_lieu) AS sk_localisation, n.n_name AS code_lieu,
         la.k AS id_lieu, la.types_lieu, la.nb_occurrences, n.n_name AS departement, r.r_name AS region
  FROM loc_agg la JOIN nation n ON la.k = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
fait_hospitalisation AS (
  SELECT p.sk_patient, coalesce(e.sk_etablissement, -1) AS sk_etablissement,
         coalesce(d.sk_diagnostic, -1) AS sk_diagnostic, t.sk_temps, l.l_orderkey AS num_hospitalisation,
         l.l_linenumber AS num_ligne, CAST(l.l_quantity AS INTEGER) AS jour_hospitalisation,
         1 AS nombre_hospitalisations
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN dim_patient p ON o.o_custkey = p.id_patient
       JOIN dim_temps t ON CAST(l.l_shipdate AS DATE) = t.date_complete
       LEFT JOIN dim_etablissement e ON l.l_suppkey = e.id_etablissement
       LEFT JOIN dim_diagnostic d ON l.l_partkey = d.id_diagnostic),
ord_lead AS (SELECT l_orderkey, min(l_suppkey) AS prof, min(l_partkey) AS diag FROM lineitem GROUP BY l_orderkey),
fait_consultation AS (
  SELECT p.sk_patient, pr.sk_professionnel, d.sk_diagnostic, coalesce(m.sk_mutuelle, -1) AS sk_mutuelle,
         coalesce(pr.fk_organisation, -1) AS sk_etablissement, t.sk_temps, o.o_orderkey AS num_consultation,
         o.o_orderpriority AS motif, CAST(o.o_orderkey % 45 AS INTEGER) AS duree_consultation,
         1 AS nombre_consultations
  FROM orders o JOIN ord_lead ol ON o.o_orderkey = ol.l_orderkey JOIN dim_patient p ON o.o_custkey = p.id_patient
       JOIN dim_professionnel pr ON CAST(ol.prof AS VARCHAR) = pr.identifiant AND pr.est_actuel
       JOIN dim_diagnostic d ON ol.diag = d.id_diagnostic
       JOIN dim_temps t ON CAST(o.o_orderdate AS DATE) = t.date_complete
       LEFT JOIN dim_mutuelle m ON o.o_orderpriority = m.id_mut),
deaths_src AS (
  SELECT e.event_id, e.user_id, CAST(e.ts AS DATE) AS date_deces,
         substring(sha256('Customer#' || lpad(CAST(e.user_id AS VARCHAR), 9, '0')), 1, 8) AS nom_a,
         substring(sha256(c.c_mktsegment), 1, 8) AS prenom_a,
         {_birth('e.user_id', "CASE WHEN e.event_type = 'error' THEN 1 ELSE 0 END")} AS birth,
         c.c_nationkey AS nat
  FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey),
fait_deces AS (
  SELECT coalesce(p.sk_patient, -1) AS sk_patient, coalesce(l.sk_localisation, -1) AS sk_localisation,
         t.sk_temps, d.event_id AS numero_acte_deces, 1 AS nombre_deces
  FROM deaths_src d JOIN dim_temps t ON d.date_deces = t.date_complete
       LEFT JOIN (SELECT * FROM dim_localisation WHERE types_lieu LIKE '%Deces%') l ON d.nat = l.id_lieu
       LEFT JOIN dim_patient p ON d.nom_a = p.nom_anonyme AND d.prenom_a = p.prenom_anonyme
                              AND d.birth = p.date_naissance),
surveys AS (
  SELECT lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS finess, CAST(year(l_shipdate) AS INTEGER) AS annee_enquete,
         avg(l_discount) * 1000 AS score_global, CAST(sum(l_quantity) AS BIGINT) AS nombre_reponses,
         avg(l_tax) * 1000 AS taux_recommandation, CAST(NULL AS VARCHAR) AS region
  FROM lineitem GROUP BY l_suppkey, year(l_shipdate)),
sv_needles AS (SELECT DISTINCT finess FROM surveys),
sv_found AS (
  SELECT n.finess, coalesce(
           (SELECT min(e.sk_etablissement) FROM dim_etablissement e WHERE e.finess_site LIKE '%' || n.finess || '%'),
           (SELECT min(e.sk_etablissement) FROM dim_etablissement e WHERE e.finess LIKE '%' || n.finess || '%'),
           (SELECT min(e.sk_etablissement) FROM dim_etablissement e
             WHERE e.finess_etablissement_juridique LIKE '%' || n.finess || '%'),
           -1) AS sk_etablissement
  FROM sv_needles n),
fait_satisfaction AS (
  SELECT f.sk_etablissement, s.finess, s.region, s.annee_enquete, s.score_global, s.taux_recommandation,
         s.nombre_reponses
  FROM surveys s LEFT JOIN sv_found f ON s.finess = f.finess),
hmart AS (
  SELECT fh.sk_temps, fh.sk_etablissement, fh.sk_diagnostic, fh.sk_patient, t.date_complete, t.annee, t.trimestre,
         t.mois, e.nom_etablissement, e.region AS region_etablissement, d.code_diagnostic, d.libelle_diagnostic,
         p.sexe, p.tranche_age, fh.nombre_hospitalisations, fh.jour_hospitalisation
  FROM fait_hospitalisation fh LEFT JOIN dim_temps t ON fh.sk_temps = t.sk_temps
       LEFT JOIN dim_etablissement e ON fh.sk_etablissement = e.sk_etablissement
       LEFT JOIN dim_diagnostic d ON fh.sk_diagnostic = d.sk_diagnostic
       LEFT JOIN dim_patient p ON fh.sk_patient = p.sk_patient),
cmart AS (
  SELECT fc.sk_temps, fc.sk_etablissement, fc.sk_diagnostic, fc.sk_professionnel, fc.sk_patient, t.date_complete,
         t.annee, t.trimestre, t.mois, e.nom_etablissement, e.region AS region_etablissement,
         e.categorie AS type_etablissement, d.code_diagnostic, d.libelle_diagnostic,
         d.categorie_cim10 AS categorie_diagnostic, pr.profession, s.specialite, fc.nombre_consultations,
         fc.duree_consultation
  FROM fait_consultation fc LEFT JOIN dim_temps t ON fc.sk_temps = t.sk_temps
       LEFT JOIN dim_etablissement e ON fc.sk_etablissement = e.sk_etablissement
       LEFT JOIN dim_diagnostic d ON fc.sk_diagnostic = d.sk_diagnostic
       LEFT JOIN dim_professionnel pr ON fc.sk_professionnel = pr.sk_professionnel
       LEFT JOIN dim_specialite s ON pr.fk_specialite = s.sk_specialite),
dmart AS (
  SELECT fd.sk_temps, t.annee, t.trimestre, t.mois, t.date_complete, l.region, l.departement,
         CAST(sum(fd.nombre_deces) AS BIGINT) AS nb_deces_departement
  FROM fait_deces fd LEFT JOIN dim_temps t ON fd.sk_temps = t.sk_temps
       LEFT JOIN dim_localisation l ON fd.sk_localisation = l.sk_localisation
  WHERE t.annee = 2024 AND l.region IS NOT NULL AND l.region != 'Non renseigne'
  GROUP BY 1, 2, 3, 4, 5, 6, 7),
sat98 AS (
  SELECT fs.sk_etablissement, coalesce(fs.region, e.region) AS region, fs.score_global, fs.nombre_reponses,
         fs.taux_recommandation
  FROM fait_satisfaction fs LEFT JOIN dim_etablissement e ON fs.sk_etablissement = e.sk_etablissement
  WHERE fs.annee_enquete = 1998 AND coalesce(fs.region, e.region) IS NOT NULL
    AND coalesce(fs.region, e.region) != 'Non renseigne'),
smart AS (
  SELECT CAST(19980101 AS BIGINT) AS sk_temps, 1998 AS annee, 1 AS trimestre, 1 AS mois,
         DATE '1998-01-01' AS date_complete, region,
         count(DISTINCT sk_etablissement) AS nb_etablissements_region,
         CAST(sum(nombre_reponses) AS BIGINT) AS nb_reponses_totales_region,
         sum(score_global * nombre_reponses) / nullif(sum(nombre_reponses), 0) AS taux_satisfaction_moyen_region,
         sum(taux_recommandation * nombre_reponses) / nullif(sum(nombre_reponses), 0)
           AS taux_recommandation_moyen_region,
         min(score_global) AS note_min_region, max(score_global) AS note_max_region,
         avg(score_global) AS note_moyenne_simple_region
  FROM sat98 GROUP BY region)"""


def with_wh(final: str, **kw) -> str:
    return "WITH " + warehouse_ctes(**kw) + "\n" + final


# --- the per-operator queries ---------------------------------------------------------------------

ORDER_BOUNDS = ("SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders")


def _order_calendar() -> str:
    return "WITH b AS (" + ORDER_BOUNDS + ")," + calendar_ctes(
        "SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM b",
        "SELECT CAST(unnest(range(year(lo), year(hi) + 1)) AS INTEGER) AS y FROM b") + """,
per_day AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1)
"""


CALENDAR_DAYS = _order_calendar() + """
SELECT t.*, CAST(coalesce(p.n, 0) AS BIGINT) AS nb_commandes
FROM dim_temps t LEFT JOIN per_day p ON t.date_complete = p.d"""

CALENDAR_HOLIDAYS = _order_calendar() + """
SELECT h.date_ferie, h.nom_ferie, CAST(year(h.date_ferie) AS INTEGER) AS annee,
       isodow(h.date_ferie) IN (6, 7) AS est_weekend, CAST(coalesce(p.n, 0) AS BIGINT) AS nb_commandes
FROM holidays h LEFT JOIN per_day p ON h.date_ferie = p.d"""

DATE_PARSE_MULTI = """
WITH parts AS (SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) AS y, CAST(month(o_orderdate) AS VARCHAR) AS m,
                      CAST(day(o_orderdate) AS VARCHAR) AS dd FROM orders),
txt AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN m || '/' || dd || '/' || y
                                              WHEN 1 THEN dd || '/' || m || '/' || y
                                              WHEN 2 THEN y || '-' || lpad(m, 2, '0') || '-' || lpad(dd, 2, '0')
                                              ELSE y || '-' || m END AS date_texte FROM parts)
SELECT o_orderkey, date_texte,
       CAST(coalesce(try_strptime(date_texte, '%m/%d/%Y'), try_strptime(date_texte, '%d/%m/%Y'),
                     TRY_CAST(date_texte AS DATE)) AS DATE) AS date_parsee
FROM txt"""

DECIMAL_COMMA = """
WITH t AS (SELECT l_orderkey, l_linenumber,
                  CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || ',' ||
                  lpad(CAST(CAST(round(l_discount * 100) AS BIGINT) AS VARCHAR), 2, '0') AS valeur_texte
           FROM lineitem)
SELECT l_orderkey, l_linenumber, valeur_texte, CAST(replace(valeur_texte, ',', '.') AS DOUBLE) AS valeur FROM t"""

AGE_YEARS = """
WITH t AS (SELECT o_orderkey, CAST(DATE '1940-01-01' + CAST((o_custkey * 7919) % 20000 AS INTEGER) AS DATE)
                  AS date_naissance, CAST(o_orderdate AS DATE) AS date_commande FROM orders)
SELECT o_orderkey, date_naissance, date_commande,
       CAST(date_part('year', age(date_commande, date_naissance)) AS INTEGER) AS age FROM t"""


def _clock(secs: str) -> str:
    return (f"lpad(CAST({secs} // 3600 AS VARCHAR), 2, '0') || ':' || "
            f"lpad(CAST(({secs} % 3600) // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST({secs} % 60 AS VARCHAR), 2, '0')")


DURATION_MINUTES = f"""
WITH s AS (SELECT event_id, CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS BIGINT) AS st FROM events),
c AS (SELECT event_id, {_clock('st')} AS heure_debut, {_clock('((st + (event_id * 97) % 86400) % 86400)')} AS heure_fin
      FROM s),
m AS (SELECT event_id, heure_debut, heure_fin,
             CAST(date_part('hour', (DATE '2025-01-01' + CAST(heure_fin AS TIME))
                                    - (DATE '2025-01-01' + CAST(heure_debut AS TIME))) * 60
                + date_part('minute', (DATE '2025-01-01' + CAST(heure_fin AS TIME))
                                      - (DATE '2025-01-01' + CAST(heure_debut AS TIME))) AS INTEGER) AS duree_minutes
      FROM c)
SELECT *, CASE WHEN duree_minutes < 15 THEN 'COURTE' WHEN duree_minutes BETWEEN 15 AND 30 THEN 'NORMALE'
               WHEN duree_minutes > 30 THEN 'LONGUE' ELSE 'NON_RENSEIGNEE' END AS duree_categorie
FROM m"""

DEPARTMENT_CODE = f"""
WITH c AS (SELECT c_custkey, CAST((c_custkey * 7919) % 100000 AS VARCHAR) AS code_postal FROM customer),
d AS (SELECT *, {dept_sql('code_postal')} AS departement FROM c)
SELECT *, {region_sql('departement')} AS region FROM d"""

_TXT = "concat_ws(' ', p_name, lower(p_type), p_brand)"
RULE_CLASSIFY_PART = f"""
SELECT p_partkey, {_TXT} AS texte,
       {specialty_sql(_TXT, 'p_brand')} AS categorie_specialite,
       {like_rules(f'upper({_TXT})', R.FACILITY_TYPE_RULES, R.FACILITY_TYPE_DEFAULT)} AS type_etablissement,
       {like_rules(f'upper({_TXT})', R.FACILITY_SECTOR_RULES, R.FACILITY_SECTOR_DEFAULT)} AS secteur,
       {like_rules(f'lower({_TXT})', R.INSURER_RULES, R.INSURER_DEFAULT)} AS type_mutuelle,
       {like_rules(_TXT, R.PRACTICE_MODE_RULES, R.PRACTICE_MODE_DEFAULT)} AS mode_exercice
FROM part"""

_CATG = "upper(substring(p_type, 1, 1)) || lpad(CAST(p_size AS VARCHAR), 2, '0')"
RANGE_CLASSIFY_TYPE = f"SELECT p_partkey, {_CATG} AS categorie_cim10, {icd_sql(_CATG)} AS chapitre_cim10 FROM part"

_AGE = "CAST(c_custkey % 100 AS INTEGER)"
BAND_AGE = f"""
SELECT c_custkey, {_AGE} AS age, {age_band_sql(_AGE)} AS tranche_age,
  CASE WHEN {_AGE} < 1 THEN 'MOINS_1_AN' WHEN {_AGE} BETWEEN 1 AND 18 THEN 'ENFANT'
       WHEN {_AGE} BETWEEN 19 AND 30 THEN 'JEUNE_ADULTE' WHEN {_AGE} BETWEEN 31 AND 65 THEN 'ADULTE'
       WHEN {_AGE} > 65 THEN 'SENIOR' ELSE 'NON_RENSEIGNE' END AS tranche_age_deces,
  CASE WHEN {_AGE} < 18 THEN 'PEDIATRIE' WHEN {_AGE} > 65 THEN 'GERIATRIE' ELSE 'ADULTE' END AS categorie_patient,
  CASE WHEN {_AGE} < 1 THEN 'MORTALITE_INFANTILE' WHEN {_AGE} BETWEEN 1 AND 14 THEN 'MORTALITE_JUVENILE'
       WHEN {_AGE} BETWEEN 15 AND 44 THEN 'MORTALITE_JEUNE_ADULTE' WHEN {_AGE} BETWEEN 45 AND 64 THEN 'MORTALITE_ADULTE'
       WHEN {_AGE} BETWEEN 65 AND 84 THEN 'MORTALITE_SENIOR' ELSE 'MORTALITE_TRES_SENIOR' END AS classe_mortalite
FROM customer"""

_DAYS_ = "CAST(l_quantity AS INTEGER)"
BAND_DAYS = f"""
SELECT l_orderkey, l_linenumber, {_DAYS_} AS jours,
  CASE WHEN {_DAYS_} < 3 THEN 'COURT_SEJOUR' WHEN {_DAYS_} BETWEEN 3 AND 7 THEN 'MOYEN_SEJOUR'
       WHEN {_DAYS_} > 7 THEN 'LONG_SEJOUR' ELSE 'NON_RENSEIGNE' END AS type_sejour,
  CASE WHEN {_DAYS_} = 0 THEN 'AMBULATOIRE' WHEN {_DAYS_} = 1 THEN 'COURT_SEJOUR'
       WHEN {_DAYS_} BETWEEN 2 AND 7 THEN 'SEJOUR_NORMAL' WHEN {_DAYS_} BETWEEN 8 AND 21 THEN 'SEJOUR_LONG'
       ELSE 'SEJOUR_TRES_LONG' END AS classe_sejour
FROM lineitem"""

NAME_NORMALISE = r"""
SELECT page_id, url,
  regexp_replace(regexp_replace(lower(regexp_replace(regexp_replace(
      replace(replace(url, '.csv', ''), '.xlsx', ''), '[^\w\s-]', '_', 'g'), '[-\s]+', '_', 'g')),
    '_+', '_', 'g'), '^_+|_+$', '', 'g') AS nom_table
FROM pages"""

SK_CUSTOMER = "SELECT *, row_number() OVER (ORDER BY c_custkey) AS sk_patient FROM customer"

SK_TWO_KEY = """
SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                                      l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS sk_fait
FROM lineitem"""

PSEUDONYM_CUSTOMER = """
SELECT c_custkey, substring(sha256(c_name), 1, 8) AS nom_anonyme, substring(sha256(c_mktsegment), 1, 8) AS prenom_anonyme,
       sha256(concat_ws('|', c_name, c_mktsegment)) AS hash_complet
FROM customer"""

LOOKUP_REQUIRED = """
WITH p AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS sk_patient FROM customer)
SELECT l.l_orderkey, l.l_linenumber, p.sk_patient,
       CAST(strftime(CAST(l.l_shipdate AS DATE), '%Y%m%d') AS BIGINT) AS sk_temps,
       CAST(l.l_quantity AS INTEGER) AS jour_hospitalisation
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN p ON o.o_custkey = p.c_custkey
WHERE CAST(l.l_shipdate AS DATE) BETWEEN DATE '1995-01-01' AND DATE '2000-12-31'"""

LOOKUP_DEFAULT = """
WITH d AS (SELECT p_partkey, p_retailprice < 1500 AS est_actuel,
                  row_number() OVER (ORDER BY p_partkey) AS sk_diagnostic FROM part)
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, coalesce(d.sk_diagnostic, -1) AS sk_diagnostic
FROM lineitem l LEFT JOIN (SELECT * FROM d WHERE est_actuel) d ON l.l_partkey = d.p_partkey"""

BRIDGE_FANOUT = """
WITH m AS (SELECT DISTINCT o_custkey, o_orderpriority, 'ACTIF' AS statut FROM orders),
ins AS (SELECT id_mut, row_number() OVER (ORDER BY id_mut) AS sk_mutuelle
        FROM (SELECT DISTINCT o_orderpriority AS id_mut FROM orders WHERE NOT starts_with(o_orderpriority, '5')))
SELECT c.c_custkey, m.o_orderpriority AS priorite, ins.sk_mutuelle, m.statut AS statut_adhesion,
       coalesce(ins.sk_mutuelle IS NOT NULL AND m.statut = 'ACTIF', false) AS a_mutuelle_active
FROM customer c LEFT JOIN m ON c.c_custkey = m.o_custkey LEFT JOIN ins ON m.o_orderpriority = ins.id_mut"""

RESIDUAL_LIKE_JOIN = with_wh("""
SELECT l.l_orderkey, l.l_linenumber, c.c_nationkey, coalesce(dl.sk_localisation, -1) AS sk_localisation
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN (SELECT * FROM dim_localisation WHERE types_lieu LIKE '%Etablissement%') dl ON c.c_nationkey = dl.id_lieu""")

PSEUDONYM_MATCH = with_wh("""
SELECT d.event_id, d.nom_a AS nom_anonyme, coalesce(p.sk_patient, -1) AS sk_patient
FROM deaths_src d LEFT JOIN dim_patient p ON d.nom_a = p.nom_anonyme AND d.prenom_a = p.prenom_anonyme
                                        AND d.birth = p.date_naissance""")

CONTAINMENT_CASCADE = """
WITH dim AS (SELECT row_number() OVER (ORDER BY s_name, code_secondaire, code_juridique, s_suppkey) AS sk_etablissement, *
             FROM (SELECT s_name, CAST(s_suppkey * 7919 AS VARCHAR) AS code_secondaire,
                          concat_ws('-', CAST(s_nationkey AS VARCHAR), CAST(s_suppkey AS VARCHAR)) AS code_juridique,
                          s_suppkey FROM supplier)),
survey AS (SELECT CAST(l_partkey AS VARCHAR) AS finess, CAST(year(l_shipdate) AS INTEGER) AS annee,
                  CAST(sum(l_quantity) AS BIGINT) AS nombre_reponses FROM lineitem GROUP BY 1, 2),
needles AS (SELECT DISTINCT finess FROM survey),
found AS (SELECT n.finess,
            (SELECT min(sk_etablissement) FROM dim WHERE dim.s_name LIKE '%' || n.finess || '%') AS k1,
            (SELECT min(sk_etablissement) FROM dim WHERE dim.code_secondaire LIKE '%' || n.finess || '%') AS k2,
            (SELECT min(sk_etablissement) FROM dim WHERE dim.code_juridique LIKE '%' || n.finess || '%') AS k3
          FROM needles n)
SELECT s.finess, s.annee, s.nombre_reponses, CAST(coalesce(f.k1, f.k2, f.k3, -1) AS BIGINT) AS sk_etablissement,
       CASE WHEN f.k1 IS NOT NULL THEN 1 WHEN f.k2 IS NOT NULL THEN 2 WHEN f.k3 IS NOT NULL THEN 3 ELSE -1 END AS etape
FROM survey s JOIN found f ON s.finess = f.finess"""

STAR_MART_LINEITEM = with_wh("SELECT * FROM hmart")
STAR_MART_CONSULTATION = with_wh("SELECT * FROM cmart")
DEATHS_REGION_DAY = with_wh("SELECT * FROM dmart")
WEIGHTED_REGION_SCORE = with_wh("SELECT * FROM smart")
PLACE_CONSOLIDATED = with_wh(
    "SELECT code_lieu, id_lieu, types_lieu, nb_occurrences, departement, region, sk_localisation FROM dim_localisation")


def _grains(kind: str) -> str:
    if kind == "consultation":
        base = """
cbase AS (
  SELECT fc.sk_temps, t.date_complete, t.annee, t.trimestre, t.mois, fc.sk_etablissement, e.nom_etablissement,
         e.region AS region_etablissement, e.departement AS departement_etablissement, fc.sk_diagnostic,
         d.code_diagnostic, d.libelle_diagnostic, d.chapitre_cim10, d.categorie_cim10, fc.sk_professionnel,
         pr.nom_anonyme AS nom_professionnel, pr.prenom_anonyme AS prenom_professionnel, s.specialite, s.fonction,
         p.sexe, p.tranche_age, p.age, fc.sk_patient, fc.nombre_consultations AS n, fc.duree_consultation AS dur
  FROM fait_consultation fc LEFT JOIN dim_temps t ON fc.sk_temps = t.sk_temps
       LEFT JOIN dim_diagnostic d ON fc.sk_diagnostic = d.sk_diagnostic
       LEFT JOIN dim_professionnel pr ON fc.sk_professionnel = pr.sk_professionnel
       LEFT JOIN dim_specialite s ON pr.fk_specialite = s.sk_specialite
       LEFT JOIN dim_patient p ON fc.sk_patient = p.sk_patient
       LEFT JOIN dim_etablissement e ON fc.sk_etablissement = e.sk_etablissement
  WHERE pr.est_actuel = true)"""
        noun, grains = "consultations", [
            ("etablissement", ["sk_temps", "sk_etablissement"], None, False),
            ("diagnostic", ["sk_temps", "sk_etablissement", "sk_diagnostic"], None, False),
            ("professionnel", ["sk_temps", "sk_professionnel"], None, False),
            ("profil", ["sk_temps", "sexe", "tranche_age", "age"], "sexe != 'I' AND tranche_age != 'Non renseigne'",
             False)]
        out_cols = ("sk_temps, date_complete, annee, trimestre, mois, sk_etablissement, nom_etablissement, "
                    "region_etablissement, departement_etablissement, sk_diagnostic, code_diagnostic, "
                    "libelle_diagnostic, chapitre_cim10, categorie_cim10, sk_professionnel, nom_professionnel, "
                    "prenom_professionnel, specialite, fonction, sexe, tranche_age, age")
        bname = "cbase"
    else:
        base = """
hbase AS (
  SELECT fh.sk_temps, t.date_complete, t.annee, t.trimestre, t.mois, fh.sk_etablissement, e.nom_etablissement,
         e.region AS region_etablissement, e.departement AS departement_etablissement, fh.sk_diagnostic,
         d.code_diagnostic, d.libelle_diagnostic, d.chapitre_cim10, d.categorie_cim10, p.sexe, p.tranche_age, p.age,
         fh.sk_patient, fh.nombre_hospitalisations AS n, fh.jour_hospitalisation AS dur
  FROM fait_hospitalisation fh LEFT JOIN dim_temps t ON fh.sk_temps = t.sk_temps
       LEFT JOIN dim_etablissement e ON fh.sk_etablissement = e.sk_etablissement
       LEFT JOIN dim_diagnostic d ON fh.sk_diagnostic = d.sk_diagnostic
       LEFT JOIN dim_patient p ON fh.sk_patient = p.sk_patient)"""
        noun, grains = "hospitalisations", [
            ("etablissement", ["sk_temps", "sk_etablissement"], None, True),
            ("diagnostic", ["sk_temps", "sk_etablissement", "sk_diagnostic"], None, True),
            ("profil", ["sk_temps", "sexe", "tranche_age", "age"], "sexe != 'I' AND tranche_age != 'Non renseigne'",
             True),
            ("region", ["sk_temps", "region_etablissement"],
             "region_etablissement IS NOT NULL AND region_etablissement != 'Non renseigne'", True)]
        out_cols = ("sk_temps, date_complete, annee, trimestre, mois, sk_etablissement, nom_etablissement, "
                    "region_etablissement, departement_etablissement, sk_diagnostic, code_diagnostic, "
                    "libelle_diagnostic, chapitre_cim10, categorie_cim10, sexe, tranche_age, age")
        bname = "hbase"
    ctes, joins, sel = [base], [], []
    for g, keys, where, with_avg in grains:
        group_keys = keys
        meas = [f"CAST(sum(n) AS BIGINT) AS nb_{noun}_{g}", f"CAST(sum(dur) AS BIGINT) AS duree_totale_{g}",
                f"count(DISTINCT sk_patient) AS nb_patients_uniques_{g}"]
        if with_avg:
            meas.append(f"avg(dur) AS duree_moyenne_{g}")
        ctes.append(f"g_{g} AS (SELECT {', '.join(group_keys)}, {', '.join(meas)} FROM {bname}"
                    + (f" WHERE {where}" if where else "") + f" GROUP BY {', '.join(group_keys)})")
        joins.append(f"LEFT JOIN g_{g} ON " + " AND ".join(f"b.{k} = g_{g}.{k}" for k in keys))
        names = [f"nb_{noun}_{g}", f"duree_totale_{g}", f"nb_patients_uniques_{g}"] + \
                ([f"duree_moyenne_{g}"] if with_avg else [])
        sel += [f"coalesce(g_{g}.{m}, 0) AS {m}" for m in names]
    cols = ", ".join("b." + c.strip() for c in out_cols.split(","))
    return ("WITH " + warehouse_ctes() + ",\n" + ",\n".join(c.strip() for c in ctes)
            + f"\nSELECT {cols}, {', '.join(sel)}\nFROM {bname} b " + " ".join(joins))


GRAINS_CONSULTATION = _grains("consultation")
GRAINS_STAY = _grains("stay")

REGION_FULL_OUTER = "WITH " + warehouse_ctes() + """,
dbase AS (
  SELECT fd.sk_temps, fd.sk_patient, t.date_complete, t.annee, t.trimestre, t.mois, l.region, p.sexe, p.tranche_age,
         fd.nombre_deces
  FROM fait_deces fd LEFT JOIN dim_temps t ON fd.sk_temps = t.sk_temps
       LEFT JOIN dim_localisation l ON fd.sk_localisation = l.sk_localisation
       LEFT JOIN dim_patient p ON fd.sk_patient = p.sk_patient
  WHERE l.region IS NOT NULL AND l.region != 'Non renseigne'),
sbase AS (
  SELECT CAST(fs.annee_enquete * 10000 + 101 AS BIGINT) AS sk_temps, fs.sk_etablissement, t.date_complete, t.annee,
         t.trimestre, t.mois, e.region AS region_etablissement, 'I' AS sexe, fs.score_global, fs.nombre_reponses
  FROM fait_satisfaction fs LEFT JOIN dim_temps t ON CAST(fs.annee_enquete * 10000 + 101 AS BIGINT) = t.sk_temps
       LEFT JOIN dim_etablissement e ON fs.sk_etablissement = e.sk_etablissement
  WHERE e.region IS NOT NULL AND e.region != 'Non renseigne'),
dr AS (
  SELECT sk_temps, region, annee, trimestre, mois, date_complete,
         CAST(sum(nombre_deces) AS BIGINT) AS nb_deces_region, count(DISTINCT sk_patient) AS nb_patients_deces_region,
         CAST(sum(CASE WHEN sexe = 'M' THEN nombre_deces ELSE 0 END) AS BIGINT) AS nb_deces_hommes,
         CAST(sum(CASE WHEN sexe = 'F' THEN nombre_deces ELSE 0 END) AS BIGINT) AS nb_deces_femmes,
         CAST(sum(CASE WHEN tranche_age = '0-18' THEN nombre_deces ELSE 0 END) AS BIGINT) AS nb_deces_0_18,
         CAST(sum(CASE WHEN tranche_age = '19-30' THEN nombre_deces ELSE 0 END) AS BIGINT) AS nb_deces_19_30,
         CAST(sum(CASE WHEN tranche_age = '31-50' THEN nombre_deces ELSE 0 END) AS BIGINT) AS nb_deces_31_50,
         CAST(sum(CASE WHEN tranche_age = '51-65' THEN nombre_deces ELSE 0 END) AS BIGINT) AS nb_deces_51_65,
         CAST(sum(CASE WHEN tranche_age = '66+' THEN nombre_deces ELSE 0 END) AS BIGINT) AS nb_deces_66_plus
  FROM dbase GROUP BY 1, 2, 3, 4, 5, 6),
sr AS (
  SELECT sk_temps, region_etablissement, annee, trimestre, mois, date_complete,
         CAST(sum(nombre_reponses) AS BIGINT) AS nb_reponses_satisfaction, avg(score_global) AS note_moyenne_satisfaction,
         count(DISTINCT sk_etablissement) AS nb_etablissements_satisfaction,
         CAST(sum(CASE WHEN sexe = 'M' THEN nombre_reponses ELSE 0 END) AS BIGINT) AS nb_reponses_hommes,
         CAST(sum(CASE WHEN sexe = 'F' THEN nombre_reponses ELSE 0 END) AS BIGINT) AS nb_reponses_femmes,
         avg(CASE WHEN sexe = 'M' THEN score_global END) AS note_moyenne_hommes,
         avg(CASE WHEN sexe = 'F' THEN score_global END) AS note_moyenne_femmes
  FROM sbase GROUP BY 1, 2, 3, 4, 5, 6)
SELECT coalesce(dr.sk_temps, sr.sk_temps) AS sk_temps, coalesce(dr.date_complete, sr.date_complete) AS date_complete,
       coalesce(dr.annee, sr.annee) AS annee, coalesce(dr.trimestre, sr.trimestre) AS trimestre,
       coalesce(dr.mois, sr.mois) AS mois, coalesce(dr.region, sr.region_etablissement) AS region,
       coalesce(dr.nb_deces_region, 0) AS nb_deces_region,
       coalesce(dr.nb_patients_deces_region, 0) AS nb_patients_deces_region,
       coalesce(dr.nb_deces_hommes, 0) AS nb_deces_hommes, coalesce(dr.nb_deces_femmes, 0) AS nb_deces_femmes,
       coalesce(dr.nb_deces_0_18, 0) AS nb_deces_0_18, coalesce(dr.nb_deces_19_30, 0) AS nb_deces_19_30,
       coalesce(dr.nb_deces_31_50, 0) AS nb_deces_31_50, coalesce(dr.nb_deces_51_65, 0) AS nb_deces_51_65,
       coalesce(dr.nb_deces_66_plus, 0) AS nb_deces_66_plus,
       coalesce(sr.nb_reponses_satisfaction, 0) AS nb_reponses_satisfaction,
       coalesce(sr.note_moyenne_satisfaction, 0) AS note_moyenne_satisfaction, 0 AS nb_patients_satisfaction,
       coalesce(sr.nb_etablissements_satisfaction, 0) AS nb_etablissements_satisfaction,
       coalesce(sr.nb_reponses_hommes, 0) AS nb_reponses_hommes, coalesce(sr.nb_reponses_femmes, 0) AS nb_reponses_femmes,
       coalesce(sr.note_moyenne_hommes, 0) AS note_moyenne_hommes,
       coalesce(sr.note_moyenne_femmes, 0) AS note_moyenne_femmes
FROM dr FULL OUTER JOIN sr ON dr.sk_temps = sr.sk_temps AND dr.region = sr.region_etablissement"""

SURVEY_UNION_ALIGN = """
WITH s48 AS (SELECT lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS finess, CAST(year(l_shipdate) AS INTEGER) AS annee_enquete,
                    avg(l_discount) * 1000 AS score_global, 'E-SATIS 48h MCO' AS type_enquete,
                    avg(l_tax) * 1000 AS score_chambre, CAST(NULL AS DOUBLE) AS score_extra_1,
                    CAST(sum(l_quantity) AS BIGINT) AS nombre_reponses
             FROM lineitem GROUP BY l_suppkey, year(l_shipdate)),
sca AS (SELECT lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS finess, CAST(year(l_shipdate) AS INTEGER) AS annee_enquete,
               max(l_discount) * 1000 AS score_global, 'E-SATIS CA MCO' AS type_enquete,
               CAST(NULL AS DOUBLE) AS score_chambre, min(l_tax) * 1000 AS score_extra_1,
               CAST(count(*) AS BIGINT) AS nombre_reponses
        FROM lineitem GROUP BY l_suppkey, year(l_shipdate))
SELECT * FROM s48 UNION ALL SELECT * FROM sca"""

KPI1 = with_wh("""
SELECT annee, mois, nom_etablissement, region_etablissement,
       CAST(sum(nombre_consultations) AS BIGINT) AS total_consultations,
       count(DISTINCT sk_patient) AS patients_uniques,
       ((200 * sum(nombre_consultations) + count(DISTINCT sk_patient)) // (2 * count(DISTINCT sk_patient))) / 100.0
         AS taux_consultation
FROM cmart WHERE annee = 1998 AND nom_etablissement IS NOT NULL
GROUP BY annee, mois, nom_etablissement, region_etablissement
ORDER BY total_consultations DESC, mois, nom_etablissement, region_etablissement NULLS LAST LIMIT 10""")

KPI2 = with_wh("""
SELECT annee, trimestre, categorie_diagnostic, libelle_diagnostic,
       CAST(sum(nombre_consultations) AS BIGINT) AS consultations_totales,
       count(DISTINCT sk_etablissement) AS nb_etablissements
FROM cmart WHERE annee BETWEEN 1996 AND 1998 AND categorie_diagnostic IS NOT NULL
GROUP BY annee, trimestre, categorie_diagnostic, libelle_diagnostic
ORDER BY consultations_totales DESC, annee, trimestre, categorie_diagnostic, libelle_diagnostic NULLS LAST LIMIT 15""")

KPI3 = with_wh("""
SELECT annee, mois, CAST(sum(nombre_hospitalisations) AS BIGINT) AS hospitalisations_totales,
       avg(jour_hospitalisation) AS duree_moyenne_jours, count(DISTINCT sk_etablissement) AS nb_etablissements,
       count(DISTINCT sk_patient) AS patients_hospitalises
FROM hmart WHERE annee >= 1998 GROUP BY annee, mois ORDER BY annee, mois""")

KPI4 = with_wh("""
SELECT annee, code_diagnostic, libelle_diagnostic, CAST(sum(nombre_hospitalisations) AS BIGINT) AS nb_hospitalisations,
       avg(jour_hospitalisation) AS duree_moyenne_jours, min(jour_hospitalisation) AS duree_min_jours,
       max(jour_hospitalisation) AS duree_max_jours, count(DISTINCT sk_etablissement) AS nb_etablissements_concernes
FROM hmart WHERE annee = 1997 AND libelle_diagnostic IS NOT NULL
GROUP BY annee, code_diagnostic, libelle_diagnostic
ORDER BY nb_hospitalisations DESC, code_diagnostic NULLS LAST, libelle_diagnostic LIMIT 15""")

KPI5 = with_wh("""
SELECT annee, sexe, tranche_age, CAST(sum(nombre_hospitalisations) AS BIGINT) AS total_hospitalisations,
       avg(jour_hospitalisation) AS duree_moyenne_jours, count(DISTINCT sk_patient) AS patients_uniques,
       CAST(sum(nombre_hospitalisations) AS DOUBLE) * 100.0
         / CAST(sum(sum(nombre_hospitalisations)) OVER () AS DOUBLE) AS pourcentage_total
FROM hmart WHERE annee = 1998 AND sexe IS NOT NULL AND tranche_age IS NOT NULL
GROUP BY annee, sexe, tranche_age ORDER BY total_hospitalisations, sexe, tranche_age""")

KPI6 = with_wh("""
SELECT annee, sk_professionnel, profession, specialite, consultations_totales, patients_suivis, duree_moyenne_min,
       consultations_par_jour_ouvre
FROM (SELECT annee, sk_professionnel, profession, specialite, nom_etablissement,
             CAST(sum(nombre_consultations) AS BIGINT) AS consultations_totales,
             count(DISTINCT sk_patient) AS patients_suivis, avg(duree_consultation) AS duree_moyenne_min,
             CAST(sum(nombre_consultations) AS DOUBLE) / 220.0 AS consultations_par_jour_ouvre
      FROM cmart WHERE annee = 1998 AND profession IS NOT NULL
      GROUP BY annee, sk_professionnel, profession, specialite, nom_etablissement
      ORDER BY consultations_totales DESC, sk_professionnel, nom_etablissement NULLS LAST LIMIT 20)""")

KPI7 = with_wh("""
SELECT annee, region, CAST(sum(nb_deces_departement) AS BIGINT) AS nombre_deces_total,
       CAST(rank() OVER (ORDER BY sum(nb_deces_departement) DESC NULLS LAST) AS INTEGER) AS rang_national
FROM dmart WHERE annee = 2024 AND region IS NOT NULL GROUP BY annee, region
ORDER BY nombre_deces_total DESC, region""")

KPI8 = with_wh("""
SELECT annee, region, nb_etablissements_region, nb_reponses_totales_region,
       taux_satisfaction_moyen_region AS score_satisfaction_global, taux_recommandation_moyen_region AS taux_recommandation,
       note_min_region AS score_min, note_max_region AS score_max, note_moyenne_simple_region AS score_moyen,
       CAST(rank() OVER (ORDER BY taux_satisfaction_moyen_region DESC NULLS LAST) AS INTEGER) AS rang_national
FROM smart WHERE annee = 1998 AND region IS NOT NULL
GROUP BY annee, region, nb_etablissements_region, nb_reponses_totales_region, taux_satisfaction_moyen_region,
         taux_recommandation_moyen_region, note_min_region, note_max_region, note_moyenne_simple_region
ORDER BY score_satisfaction_global DESC NULLS LAST, region""")

KPI9 = with_wh("""
SELECT s.categorie, count(*) AS consultation_count, avg(fc.duree_consultation) AS avg_duration
FROM fait_consultation fc JOIN dim_professionnel p ON fc.sk_professionnel = p.sk_professionnel
JOIN dim_specialite s ON p.fk_specialite = s.sk_specialite
WHERE p.est_actuel = true GROUP BY s.categorie ORDER BY consultation_count DESC, s.categorie LIMIT 10""")

KPI10 = with_wh("""
SELECT e.region, avg(fh.jour_hospitalisation) AS avg_los, count(*) AS total_stays, avg(fs.score_global) AS satisfaction_score
FROM fait_hospitalisation fh JOIN dim_etablissement e ON fh.sk_etablissement = e.sk_etablissement
LEFT JOIN fait_satisfaction fs ON e.sk_etablissement = fs.sk_etablissement
GROUP BY e.region ORDER BY avg_los DESC, e.region""")

KPI11 = with_wh("""
SELECT t.annee AS year, t.trimestre AS quarter, avg(fs.score_global) AS avg_satisfaction,
       count(DISTINCT fs.sk_etablissement) AS facilities_surveyed
FROM fait_satisfaction fs JOIN dim_temps t ON CAST(fs.annee_enquete * 10000 + 101 AS BIGINT) = t.sk_temps
GROUP BY t.annee, t.trimestre ORDER BY 1, 2""")

KPI12 = f"""
SELECT * FROM (
  SELECT DISTINCT region_etablissement, specialite, nb_consultations_professionnel,
         duree_totale_professionnel / nb_consultations_professionnel AS duree_moyenne_professionnel,
         nb_patients_uniques_professionnel, sk_professionnel, sk_temps
  FROM ({GRAINS_CONSULTATION}) g
  WHERE annee = 1998 AND nb_consultations_professionnel > 1)
ORDER BY nb_consultations_professionnel DESC, sk_professionnel, sk_temps LIMIT 20"""

KPI13 = f"""
SELECT specialite, CAST(sum(nb_consultations_professionnel) AS BIGINT) AS total
FROM ({GRAINS_CONSULTATION}) g
WHERE annee = 1998 AND region_etablissement = 'EUROPE'
GROUP BY specialite ORDER BY total DESC, specialite NULLS LAST LIMIT 10"""

TERRITORIAL_SCORES = """
WITH t AS (""" + "SELECT * FROM (" + "{REGION}" + ") r" + """),
s AS (SELECT *, CASE WHEN nb_deces_region > 0 THEN CAST(nb_deces_66_plus AS DOUBLE) / nb_deces_region * 100
                     ELSE 0.0 END AS taux_deces_seniors FROM t)
SELECT sk_temps, region,
  CASE WHEN coalesce(nb_deces_region, 0) > 0 AND coalesce(note_moyenne_satisfaction, 0) > 0 THEN 'DONNEES_COMPLETES'
       WHEN coalesce(nb_deces_region, 0) > 0 THEN 'DECES_SEULEMENT'
       WHEN coalesce(note_moyenne_satisfaction, 0) > 0 THEN 'SATISFACTION_SEULEMENT'
       ELSE 'DONNEES_MANQUANTES' END AS completude_donnees_territoriales,
  taux_deces_seniors,
  CASE WHEN coalesce(nb_deces_region, 0) > 0 AND coalesce(note_moyenne_satisfaction, 0) > 0
       THEN (100 - least(taux_deces_seniors, 100)) * 0.3 + note_moyenne_satisfaction * 0.7 END
    AS score_territorial_global,
  CASE WHEN nb_etablissements_satisfaction = 0 THEN 'NON_EVALUE'
       WHEN note_moyenne_satisfaction >= 80 THEN 'EXCELLENCE_REGIONALE'
       WHEN note_moyenne_satisfaction >= 70 THEN 'TRES_SATISFAISANT'
       WHEN note_moyenne_satisfaction >= 60 THEN 'SATISFAISANT'
       WHEN note_moyenne_satisfaction >= 50 THEN 'A_AMELIORER'
       ELSE 'INSUFFISANT' END AS niveau_satisfaction_regional
FROM s"""

_ZONE_DEPT = dept_sql("CAST((c_custkey * 7919) % 100000 AS VARCHAR)")
COVERAGE_ZONE = f"""
WITH d AS (SELECT c_custkey, c_mktsegment, {_ZONE_DEPT} AS departement FROM customer),
r AS (SELECT *, {region_sql('departement')} AS region,
             upper({like_rules('lower(c_mktsegment)', R.INSURER_RULES, R.INSURER_DEFAULT)}) AS kind FROM d)
SELECT c_custkey, departement, region,
  CASE WHEN departement IN ('75', '92', '93', '94') THEN 'PARIS_PETITE_COURONNE'
       WHEN departement IN ('77', '78', '91', '95') THEN 'GRANDE_COURONNE'
       WHEN region = 'ILE_DE_FRANCE' THEN 'ILE_DE_FRANCE_AUTRE'
       WHEN departement BETWEEN '01' AND '95' THEN 'FRANCE_METROPOLITAINE'
       WHEN departement IN ('971', '972', '973', '974', '976') THEN 'OUTRE_MER'
       ELSE 'ETRANGER_OU_INCONNU' END AS zone_couverture,
  CASE WHEN kind = 'MUTUELLE' THEN 'MUTUELLE_COMPLEMENTAIRE' WHEN kind = 'ASSURANCE' THEN 'ASSURANCE_PRIVEE'
       WHEN kind = 'PREVOYANCE' THEN 'INSTITUTION_PREVOYANCE' WHEN kind = 'CMU' THEN 'COUVERTURE_UNIVERSELLE'
       ELSE 'AUTRE_ORGANISME' END AS categorie_organisme
FROM r"""

COMPLETENESS_PROFILE = """
WITH l AS (SELECT CASE WHEN l.l_quantity > 45 THEN NULL ELSE l.l_quantity END AS qte, o.o_orderpriority,
                  l.l_shipdate
           FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey)
SELECT sum(CASE WHEN qte IS NULL THEN 1 ELSE 0 END) * 100.0 / count(*) AS pct_null_qte,
       sum(CASE WHEN o_orderpriority IS NULL THEN 1 ELSE 0 END) * 100.0 / count(*) AS pct_null_o_orderpriority,
       sum(CASE WHEN l_shipdate IS NULL THEN 1 ELSE 0 END) * 100.0 / count(*) AS pct_null_l_shipdate
FROM l"""

SHARE_OF_TOTAL = with_wh("""
SELECT region_etablissement, CAST(sum(nombre_hospitalisations) AS BIGINT) AS total_hospitalisations,
       CAST(sum(nombre_hospitalisations) AS DOUBLE) * 100.0
         / CAST(sum(sum(nombre_hospitalisations)) OVER () AS DOUBLE) AS pourcentage_total
FROM hmart GROUP BY region_etablissement""")

RANK_REGION = with_wh("""
SELECT region_etablissement, annee, CAST(sum(jour_hospitalisation) AS BIGINT) AS jours,
       CAST(rank() OVER (PARTITION BY annee ORDER BY sum(jour_hospitalisation) DESC NULLS LAST) AS INTEGER) AS rang
FROM hmart GROUP BY region_etablissement, annee""")

MOVING_AVG = """
SELECT o_orderkey, o_custkey,
       avg(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                               ROWS BETWEEN 10 PRECEDING AND CURRENT ROW) AS moyenne_mobile
FROM orders"""

MEDIAN_STAY = """
WITH l AS (SELECT l_suppkey, CAST(l_quantity AS INTEGER) AS jours FROM lineitem)
SELECT l_suppkey, median(jours) AS duree_mediane, min(jours) AS duree_min, max(jours) AS duree_max,
       avg(jours) AS duree_avg,
       CASE WHEN count(*) > 0 THEN CAST(sum(jours) AS DOUBLE) / (count(*) * 30.44) * 100 ELSE 0 END AS taux_occupation,
       CASE WHEN count(*) > 0 THEN CAST(sum(CASE WHEN jours > 25 THEN 1 ELSE 0 END) AS DOUBLE) / count(*) * 100
            ELSE 0 END AS pct_longs
FROM l GROUP BY l_suppkey"""

SCD2_HISTORY = """
WITH o AS (SELECT o_custkey, o_orderkey, o_orderpriority, CAST(o_orderdate AS DATE) AS jour FROM orders),
h AS (SELECT *, lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY jour, o_orderkey) AS prev FROM o),
c AS (SELECT * FROM h WHERE prev IS NULL OR prev != o_orderpriority)
SELECT o_custkey, o_orderkey, o_orderpriority, CAST(row_number() OVER w AS INTEGER) AS numero_version,
       jour AS date_debut_validite, CAST(lead(jour) OVER w - 1 AS DATE) AS date_fin_validite,
       lead(1) OVER w IS NULL AS est_actuel
FROM c WINDOW w AS (PARTITION BY o_custkey ORDER BY jour, o_orderkey)"""

SCD2_MERGE = """
WITH cur AS (SELECT c_custkey, c_mktsegment, c_nationkey FROM customer),
inc AS (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'CHANGED' ELSE c_mktsegment END AS c_mktsegment,
               c_nationkey FROM customer),
j AS (SELECT c.c_custkey, c.c_mktsegment AS old_seg, c.c_nationkey AS old_nat, i.c_mktsegment AS new_seg,
             i.c_nationkey AS new_nat,
             (c.c_mktsegment IS DISTINCT FROM i.c_mktsegment OR c.c_nationkey IS DISTINCT FROM i.c_nationkey) AS changed
      FROM cur c JOIN inc i ON c.c_custkey = i.c_custkey)
SELECT c_custkey, old_seg AS c_mktsegment, old_nat AS c_nationkey, DATE '2024-01-01' AS date_debut_validite,
       CAST(NULL AS DATE) AS date_fin_validite, true AS est_actuel, 1 AS numero_version FROM j WHERE NOT changed
UNION ALL
SELECT c_custkey, old_seg, old_nat, DATE '2024-01-01', DATE '2024-12-31', false, 1 FROM j WHERE changed
UNION ALL
SELECT c_custkey, new_seg, new_nat, DATE '2025-01-01', CAST(NULL AS DATE), true, 2 FROM j WHERE changed"""

UPSERT_DIM = """
WITH src AS (SELECT s_suppkey, s_name, s_nationkey, round(s_acctbal + 1, 2) AS s_acctbal FROM supplier
             WHERE s_suppkey % 3 = 0)
SELECT * FROM src
UNION ALL SELECT * FROM supplier WHERE s_suppkey NOT IN (SELECT s_suppkey FROM src)"""

INCREMENTAL_APPEND = """
SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders
WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01')"""


def _check(name, table, column, failures_sql):
    col = "CAST(NULL AS VARCHAR)" if column is None else q(column)
    return (f"SELECT {q(name)} AS check_name, {q(table)} AS table_name, {col} AS column_name, "
            f"CAST({failures_sql} AS BIGINT) AS failures, CAST({failures_sql} AS BIGINT) = 0 AS passed")


DQ_UNIQUE = " UNION ALL ".join([
    _check("unique", "orders", "o_orderkey",
           "(SELECT count(*) FROM (SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1))"),
    _check("unique_combination", "lineitem", "l_orderkey,l_linenumber",
           "(SELECT count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IS NOT NULL "
           "AND l_linenumber IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1))"),
    _check("unique", "customer", "c_name",
           "(SELECT count(*) FROM (SELECT c_name FROM customer WHERE c_name IS NOT NULL GROUP BY 1 HAVING count(*) > 1))"),
])

DQ_NOT_NULL = " UNION ALL ".join(
    _check("not_null", "lineitem", c, f"(SELECT coalesce(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END), 0) FROM lineitem)")
    for c in ["l_orderkey", "l_partkey", "l_suppkey", "l_shipdate", "l_returnflag"])

DQ_RELATIONSHIP = " UNION ALL ".join([
    _check("relationship", "lineitem", "l_partkey",
           "(SELECT count(*) FROM lineitem WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM part))"),
    _check("relationship", "lineitem_vs_cheap_parts", "l_partkey",
           "(SELECT count(*) FROM lineitem WHERE l_partkey IS NOT NULL AND l_partkey NOT IN "
           "(SELECT p_partkey FROM part WHERE p_retailprice < 1500))"),
    _check("relationship", "labels", "doc_id",
           "(SELECT count(*) FROM labels WHERE doc_id IS NOT NULL AND doc_id NOT IN (SELECT doc_id FROM documents))"),
])

DQ_RANGE = " UNION ALL ".join([
    _check("accepted_range", "lineitem", "l_quantity",
           "(SELECT count(*) FROM lineitem WHERE l_quantity IS NOT NULL AND (l_quantity < 1 OR l_quantity > 40))"),
    _check("accepted_range", "lineitem", "l_discount",
           "(SELECT count(*) FROM lineitem WHERE l_discount IS NOT NULL AND (l_discount < 0.0 OR l_discount > 0.08))"),
    _check("accepted_values", "lineitem", "l_returnflag",
           "(SELECT count(*) FROM lineitem WHERE l_returnflag IS NOT NULL AND l_returnflag NOT IN ('A', 'N'))"),
    _check("holds:tax_le_discount", "lineitem", None,
           "(SELECT count(*) FROM lineitem WHERE NOT (l_tax <= l_discount))"),
    _check("min_rows", "nation", None, "(SELECT greatest(30 - count(*), 0) FROM nation)"),
    _check("max_length", "customer", "c_name", "(SELECT count(*) FROM customer WHERE length(c_name) > 17)"),
    _check("max_length", "customer", "c_mktsegment",
           "(SELECT count(*) FROM customer WHERE length(c_mktsegment) > 10)"),
])

_PROFILE = {"orders": "o_orderkey", "lineitem": "l_orderkey", "customer": "c_custkey", "part": "p_partkey",
            "supplier": "s_suppkey", "events": "user_id", "documents": "doc_id", "pages": "page_id",
            "conversations": "conv_id", "labels": "doc_id"}
DQ_PROFILE = " UNION ALL ".join(
    f"SELECT {q(t)} AS table_name, count(*) AS nb_lignes, count(DISTINCT {c}) AS nb_ids_distincts FROM {t}"
    for t, c in _PROFILE.items())

DQ_CONTRACT = """
SELECT 'customer' AS table_name, 'c_name' AS column_name,
       CAST(coalesce(sum(CASE WHEN length(c_name) > 18 THEN 1 ELSE 0 END), 0) AS BIGINT) AS failures FROM customer
UNION ALL
SELECT 'customer', 'c_mktsegment',
       CAST(coalesce(sum(CASE WHEN length(c_mktsegment) > 9 THEN 1 ELSE 0 END), 0) AS BIGINT) FROM customer
UNION ALL SELECT 'customer', 'c_phone', CAST(-1 AS BIGINT)"""

DQ_CURRENT_VERSION = "WITH m AS (" + SCD2_MERGE + ")\n" + _check(
    "one_current_version", "dim_client", "c_custkey",
    "(SELECT count(*) FROM (SELECT c_custkey FROM m WHERE est_actuel GROUP BY 1 HAVING count(*) > 1))")

CSV_ROUNDTRIP = """
SELECT 'référentiel_pièces_part_export' AS table_name, count(*) AS nb_lignes, 'SUCCESS' AS statut FROM part
UNION ALL SELECT 'ventes_lineitem_export', count(*), 'SUCCESS' FROM lineitem
UNION ALL SELECT 'ventes_orders_export', count(*), 'SUCCESS' FROM orders"""


STREAM_INCREMENTAL_LOAD = """
SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS jour, o_totalprice,
       CAST(year(o_orderdate) AS INTEGER) AS annee
FROM orders"""


KPI12_AMBULATORY = with_wh("""
SELECT *, CAST(nb_ambulatoire AS DOUBLE) * 100.0 / total_hospitalisations_etablissement AS pct_ambulatoire FROM (
  SELECT nom_etablissement, region_etablissement,
         CAST(sum(nombre_hospitalisations) AS BIGINT) AS total_hospitalisations_etablissement,
         avg(jour_hospitalisation) AS duree_moyenne_etablissement,
         CAST(sum(CASE WHEN jour_hospitalisation = 0 THEN nombre_hospitalisations ELSE 0 END) AS BIGINT)
           AS nb_ambulatoire
  FROM hmart WHERE annee = 1998 GROUP BY nom_etablissement, region_etablissement)
WHERE total_hospitalisations_etablissement > 50""")

DQ_ORPHANS = """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey
FROM lineitem l LEFT JOIN (SELECT DISTINCT p_partkey FROM part WHERE p_retailprice < 1500) p
  ON l.l_partkey = p.p_partkey
WHERE p.p_partkey IS NULL"""

DQ_DUPLICATES = """
SELECT l_orderkey, l_linenumber, count(*) AS nb FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""


ORACLES = {
    "calendar_days": CALENDAR_DAYS,
    "calendar_holidays": CALENDAR_HOLIDAYS,
    "date_parse_multi": DATE_PARSE_MULTI,
    "decimal_comma": DECIMAL_COMMA,
    "age_years": AGE_YEARS,
    "duration_minutes": DURATION_MINUTES,
    "department_code": DEPARTMENT_CODE,
    "rule_classify_part": RULE_CLASSIFY_PART,
    "range_classify_type": RANGE_CLASSIFY_TYPE,
    "band_age": BAND_AGE,
    "band_days": BAND_DAYS,
    "name_normalise": NAME_NORMALISE,
    "sk_customer": SK_CUSTOMER,
    "sk_two_key": SK_TWO_KEY,
    "pseudonym_customer": PSEUDONYM_CUSTOMER,
    "lookup_required": LOOKUP_REQUIRED,
    "lookup_default": LOOKUP_DEFAULT,
    "bridge_fanout": BRIDGE_FANOUT,
    "residual_like_join": RESIDUAL_LIKE_JOIN,
    "pseudonym_match": PSEUDONYM_MATCH,
    "containment_cascade": CONTAINMENT_CASCADE,
    "star_mart_lineitem": STAR_MART_LINEITEM,
    "star_mart_consultation": STAR_MART_CONSULTATION,
    "grains_consultation": GRAINS_CONSULTATION,
    "grains_stay": GRAINS_STAY,
    "region_full_outer": REGION_FULL_OUTER,
    "deaths_region_day": DEATHS_REGION_DAY,
    "weighted_region_score": WEIGHTED_REGION_SCORE,
    "survey_union_align": SURVEY_UNION_ALIGN,
    "place_consolidated": PLACE_CONSOLIDATED,
    "kpi1": KPI1,
    "kpi2": KPI2,
    "kpi3": KPI3,
    "kpi4": KPI4,
    "kpi5": KPI5,
    "kpi6": KPI6,
    "kpi7": KPI7,
    "kpi8": KPI8,
    "kpi9": KPI9,
    "kpi10": KPI10,
    "kpi11": KPI11,
    "kpi12": KPI12,
    "kpi13": KPI13,
    "kpi12_ambulatory": KPI12_AMBULATORY,
    "territorial_scores": TERRITORIAL_SCORES.replace("{REGION}", REGION_FULL_OUTER),
    "coverage_zone": COVERAGE_ZONE,
    "completeness_profile": COMPLETENESS_PROFILE,
    "share_of_total": SHARE_OF_TOTAL,
    "rank_region": RANK_REGION,
    "moving_avg": MOVING_AVG,
    "median_stay": MEDIAN_STAY,
    "scd2_history": SCD2_HISTORY,
    "scd2_merge": SCD2_MERGE,
    "upsert_dim": UPSERT_DIM,
    "incremental_append": INCREMENTAL_APPEND,
    "dq_unique": DQ_UNIQUE,
    "dq_not_null": DQ_NOT_NULL,
    "dq_relationship": DQ_RELATIONSHIP,
    "dq_range": DQ_RANGE,
    "dq_profile": DQ_PROFILE,
    "dq_current_version": DQ_CURRENT_VERSION,
    "dq_contract": DQ_CONTRACT,
    "dq_orphans": DQ_ORPHANS,
    "dq_duplicates": DQ_DUPLICATES,
    "csv_roundtrip": CSV_ROUNDTRIP,
    "stream_incremental_load": STREAM_INCREMENTAL_LOAD,
}

# Floating-point result columns per query (rounded to 6 digits on both sides).
DOUBLE_COLUMNS: dict[str, list[str]] = {
    'decimal_comma': ['valeur'],
    'sk_customer': ['c_acctbal'],
    'sk_two_key': ['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax'],
    'grains_stay': ['duree_moyenne_etablissement', 'duree_moyenne_diagnostic', 'duree_moyenne_profil', 'duree_moyenne_region'],
    'region_full_outer': ['note_moyenne_satisfaction', 'note_moyenne_hommes', 'note_moyenne_femmes'],
    'weighted_region_score': ['taux_satisfaction_moyen_region', 'taux_recommandation_moyen_region', 'note_min_region', 'note_max_region', 'note_moyenne_simple_region'],
    'survey_union_align': ['score_global', 'score_chambre', 'score_extra_1'],
    'kpi1': ['taux_consultation'],
    'kpi3': ['duree_moyenne_jours'],
    'kpi4': ['duree_moyenne_jours'],
    'kpi5': ['duree_moyenne_jours', 'pourcentage_total'],
    'kpi6': ['duree_moyenne_min', 'consultations_par_jour_ouvre'],
    'kpi8': ['score_satisfaction_global', 'taux_recommandation', 'score_min', 'score_max', 'score_moyen'],
    'kpi9': ['avg_duration'],
    'kpi10': ['avg_los', 'satisfaction_score'],
    'kpi11': ['avg_satisfaction'],
    'kpi12': ['duree_moyenne_professionnel'],
    'kpi12_ambulatory': ['duree_moyenne_etablissement', 'pct_ambulatoire'],
    'territorial_scores': ['taux_deces_seniors', 'score_territorial_global'],
    'completeness_profile': ['pct_null_qte', 'pct_null_o_orderpriority', 'pct_null_l_shipdate'],
    'share_of_total': ['pourcentage_total'],
    'moving_avg': ['moyenne_mobile'],
    'median_stay': ['duree_mediane', 'duree_avg', 'taux_occupation', 'pct_longs'],
    'upsert_dim': ['s_acctbal'],
    'stream_incremental_load': ['o_totalprice'],
}

"""Model registry and pipeline runner.

Each model is registered with its layer, its input names and a function. The
runner resolves inputs in dependency order; with a ``root`` every materialised
model is written to ``<root>/<layer>/<name>`` and read back, so later models
start from Parquet (lineage cut, column pruning and predicate pushdown at the
scan) exactly like the reference's table materialisation.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from carelake.plans import dwh, marts, ods, staging


@dataclass
class Model:
    name: str
    layer: str
    inputs: list[str]
    fn: Callable[..., DataFrame]
    materialize: bool = True
    partition_by: tuple = ()
    extra: dict = field(default_factory=dict)


# marts are written partitioned by year: KPI year filters (F04) prune whole folders
YEAR = ("annee",)


def _registry(as_of, spark: SparkSession, calendar_bounds: tuple | None) -> dict[str, Model]:
    R: dict[str, Model] = {}

    def add(name, layer, inputs, fn, **kw):
        R[name] = Model(name, layer, inputs, fn, **kw)

    for name, (raw, fn) in staging.STAGING.items():
        add(name, "staging", [f"raw.{raw}"], (lambda f: lambda x: f(x, as_of))(fn))

    add("int_satisfaction_esatis48h", "ods",
        ["raw.satisfaction_2020_resultats_esatis48h_mco_open_data_2020",
         "raw.satisfaction_2019_resultats_esatis48h_mco_open_data_2019",
         "raw.satisfaction_esatis48h_mco_recueil2017_donnees"],
        ods.int_satisfaction_esatis48h, materialize=False)
    add("int_satisfaction_esatisca", "ods",
        ["raw.satisfaction_2020_resultats_esatisca_mco_open_data_2020",
         "raw.satisfaction_2019_resultats_esatisca_mco_open_data_2019"],
        ods.int_satisfaction_esatisca, materialize=False)
    add("ods_satisfaction_unifie", "ods", ["int_satisfaction_esatis48h", "int_satisfaction_esatisca"],
        lambda a, b: ods.ods_satisfaction_unifie(a, b, as_of))
    add("ods_qualite_soins_unifie", "ods", ["raw.satisfaction_2017_2018_ete_ortho_ipaqss_2017_2018_donnees"],
        lambda r: ods.ods_qualite_soins_unifie(r, as_of))
    add("ods_patient_complet", "ods", ["stg_patient", "stg_adher", "stg_mutuelle"], ods.ods_patient_complet)
    add("ods_professionnel_complet", "ods",
        ["stg_professionnel_sante", "stg_etablissement_professionnel", "stg_specialites"],
        ods.ods_professionnel_complet)
    add("ods_consultation_enrichie", "ods",
        ["stg_consultation", "ods_patient_complet", "ods_professionnel_complet", "stg_diagnostic"],
        ods.ods_consultation_enrichie)
    add("ods_hospitalisation_enrichie", "ods",
        ["stg_hospitalisation", "ods_patient_complet", "stg_etablissement_sante", "stg_diagnostic"],
        ods.ods_hospitalisation_enrichie)
    add("ods_deces_enrichi", "ods", ["stg_deces"], ods.ods_deces_enrichi)
    add("ods_prescription_enrichie", "ods",
        ["stg_prescription", "stg_medicaments", "ods_consultation_enrichie"], ods.ods_prescription_enrichie)
    add("ods_localisation_consolidee", "ods", ["stg_patient", "stg_etablissement_sante", "stg_deces"],
        lambda a, b, c: ods.ods_localisation_consolidee(a, b, c, as_of))

    bounds = calendar_bounds or (dwh.cal.DEFAULT_START, dwh.cal.DEFAULT_END)
    add("dim_temps", "dwh", [], lambda: dwh.dim_temps(spark, as_of, *bounds))
    add("dim_specialite", "dwh", ["stg_specialites"], dwh.dim_specialite)
    add("dim_mutuelle", "dwh", ["stg_mutuelle"], dwh.dim_mutuelle)
    add("dim_diagnostic", "dwh", ["stg_diagnostic"], dwh.dim_diagnostic)
    add("dim_localisation", "dwh", ["ods_localisation_consolidee"], dwh.dim_localisation)
    add("dim_etablissement", "dwh", ["stg_etablissement_sante"], dwh.dim_etablissement)
    add("dim_patient", "dwh", ["ods_patient_complet"], dwh.dim_patient)
    add("dim_professionnel", "dwh",
        ["ods_professionnel_complet", "dim_specialite", "dim_etablissement", "stg_etablissement_activite"],
        lambda a, b, c, d: dwh.dim_professionnel(a, b, c, d, as_of))
    add("fait_consultation", "dwh",
        ["ods_consultation_enrichie", "dim_patient", "dim_professionnel", "dim_diagnostic", "dim_mutuelle",
         "dim_temps"], dwh.fait_consultation)
    add("fait_hospitalisation", "dwh",
        ["ods_hospitalisation_enrichie", "dim_patient", "dim_etablissement", "dim_diagnostic", "dim_temps",
         "dim_localisation"], dwh.fait_hospitalisation)
    add("fait_deces", "dwh", ["ods_deces_enrichi", "dim_patient", "dim_localisation", "dim_temps"],
        dwh.fait_deces)
    add("fait_satisfaction", "dwh", ["ods_satisfaction_unifie", "dim_etablissement"], dwh.fait_satisfaction)
    add("fait_qualite_soins", "dwh", ["ods_qualite_soins_unifie", "dim_etablissement"], dwh.fait_qualite_soins)

    add("dm_consultations_analysis", "datamart",
        ["fait_consultation", "dim_temps", "dim_etablissement", "dim_diagnostic", "dim_professionnel",
         "dim_specialite"], lambda *a: marts.dm_consultations_analysis(*a, as_of), partition_by=YEAR)
    add("dm_hospitalisations_analysis", "datamart",
        ["fait_hospitalisation", "dim_temps", "dim_etablissement", "dim_diagnostic", "dim_patient"],
        lambda *a: marts.dm_hospitalisations_analysis(*a, as_of), partition_by=YEAR)
    add("dm_deces_analysis", "datamart", ["fait_deces", "dim_temps", "dim_localisation"],
        lambda *a: marts.dm_deces_analysis(*a, as_of), partition_by=YEAR)
    add("dm_satisfaction_analysis", "datamart", ["fait_satisfaction", "dim_etablissement"],
        lambda *a: marts.dm_satisfaction_analysis(*a, as_of), partition_by=YEAR)
    add("dm_consultations_agregees", "datamart",
        ["fait_consultation", "dim_temps", "dim_etablissement", "dim_diagnostic", "dim_professionnel",
         "dim_specialite", "dim_patient"], lambda *a: marts.dm_consultations_agregees(*a, as_of), partition_by=YEAR)
    add("dm_analyse_territoriale", "datamart",
        ["fait_deces", "fait_satisfaction", "dim_temps", "dim_localisation", "dim_patient",
         "dim_etablissement"], lambda *a: marts.dm_analyse_territoriale(*a, as_of), partition_by=YEAR)
    add("dm_hospitalisations_agregees", "datamart",
        ["fait_hospitalisation", "dim_temps", "dim_etablissement", "dim_diagnostic", "dim_patient"],
        lambda *a: marts.dm_hospitalisations_agregees(*a, as_of), partition_by=YEAR)
    return R


LAYERS = ["staging", "ods", "dwh", "datamart"]


def topological_order(models: Mapping[str, Model]) -> list[str]:
    """Dependency order (inputs first); raw inputs are leaves."""
    seen: set[str] = set()
    order: list[str] = []

    def visit(n: str, stack: tuple = ()):
        if n in seen or n.startswith("raw."):
            return
        if n in stack:
            raise ValueError(f"cycle through {n}")
        for i in models[n].inputs:
            visit(i, stack + (n,))
        seen.add(n)
        order.append(n)

    for n in models:
        visit(n)
    return order


class Pipeline:
    """Lazy evaluation of the model graph with optional materialisation."""

    def __init__(self, spark: SparkSession, raw: Mapping[str, DataFrame], as_of, root: str | None = None,
                 layers: tuple = tuple(LAYERS), calendar_bounds: tuple | None = None):
        self.spark = spark
        self.raw = dict(raw)
        self.root = root
        self.layers = layers
        self.models = _registry(as_of, spark, calendar_bounds)
        self._cache: dict[str, DataFrame] = {}

    def get(self, name: str) -> DataFrame:
        if name.startswith("raw."):
            return self.raw[name[4:]]
        if name in self._cache:
            return self._cache[name]
        m = self.models[name]
        df = m.fn(*[self.get(i) for i in m.inputs])
        if self.root and m.materialize:
            from carelake.sources.io import read_layer, write_layer
            write_layer(df, self.root, m.layer, name, partition_by=m.partition_by)
            df = read_layer(self.spark, self.root, m.layer, name)
        self._cache[name] = df
        return df

    def levels(self) -> list[list[str]]:
        """Models grouped by dependency depth: a level only reads earlier levels."""
        depth: dict[str, int] = {}
        for n in topological_order(self.models):
            deps = [i for i in self.models[n].inputs if not i.startswith("raw.")]
            depth[n] = 1 + max((depth[d] for d in deps), default=-1)
        out: list[list[str]] = [[] for _ in range(max(depth.values()) + 1)]
        for n, d in depth.items():
            out[d].append(n)
        return out

    def run(self, names: list[str] | None = None, parallel: int = 4) -> dict[str, DataFrame]:
        """Build the selected models. When materialising, the models of one
        dependency level are independent and are written as concurrent Spark jobs."""
        order = topological_order(self.models)
        wanted = [n for n in order if self.models[n].layer in self.layers and (names is None or n in names)]
        if self.root and parallel > 1:
            from concurrent.futures import ThreadPoolExecutor
            needed = set(wanted)
            for n in wanted:  # include upstream models of the selection
                stack = list(self.models[n].inputs)
                while stack:
                    d = stack.pop()
                    if not d.startswith("raw.") and d not in needed:
                        needed.add(d)
                        stack.extend(self.models[d].inputs)
            with ThreadPoolExecutor(max_workers=parallel) as pool:
                for level in self.levels():
                    todo = [n for n in level if n in needed]
                    list(pool.map(self.get, todo))
        return {n: self.get(n) for n in wanted}


def run_pipeline(spark: SparkSession, raw: Mapping[str, DataFrame], as_of, root: str | None = None,
                 layers: tuple = tuple(LAYERS), calendar_bounds: tuple | None = None) -> dict[str, DataFrame]:
    """Build every model of the selected layers; returns name -> DataFrame."""
    return Pipeline(spark, raw, as_of, root, layers, calendar_bounds).run()

"""What a dataset looks like: column variants, sentinels, labels, bounds.

The operators know nothing about a particular source; they are driven by these
dataclasses. ``INCIDENTS`` describes the yearly incident files.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field

AUDIT_COLUMNS = ("_arquivo_origem", "_guia_origem", "_ano_arquivo", "_dt_ingestao")


@dataclass(frozen=True)
class Field:
    """One canonical column: the source headers it may carry, and how it is cleaned.

    ``kind`` is one of text, hour, label, int, date, coordinate.
    """

    name: str
    variants: tuple[str, ...]
    kind: str = "text"


@dataclass(frozen=True)
class CleaningRules:
    fields: tuple[Field, ...]
    text_sentinels: tuple[str, ...]
    hour_sentinels: tuple[str, ...]
    coordinate_sentinels: tuple[str, ...]
    labels: Mapping[str, str]
    city_column: str
    date_column: str
    lineage: tuple[str, ...] = ("_arquivo_origem", "_guia_origem")
    month_column: str = "ano_mes_ocorrencia"
    undated_month: str = "000000"


@dataclass(frozen=True)
class StarRules:
    """Natural keys of the dimensions and the member that stands for a missing one."""

    member: str
    type_keys: tuple[str, ...]
    weekday_names: tuple[str, ...]


@dataclass(frozen=True)
class QualityRules:
    date_floor: dt.date
    date_ceiling: dt.date
    lat_bounds: tuple[float, float]
    lon_bounds: tuple[float, float]
    unique_key: tuple[str, ...]
    sensitive_pattern: str
    categories: tuple[str, ...]
    sentinel_counts: Mapping[str, tuple[str, str]] = field(default_factory=dict)


# Canonical column, source headers in order of preference, kind.
INCIDENT_FIELDS = (
    Field("municipio", ("CIDADE", "NOME_MUNICIPIO")),
    Field("num_bo", ("NUM_BO",)),
    Field("ano_bo", ("ANO_BO",), "int"),
    Field("dt_ocorrencia_bo", ("DATA_OCORRENCIA_BO",), "date"),
    Field("dt_registro_bo", ("DATA_COMUNICACAO_BO", "DATA_REGISTRO"), "date"),
    Field("hora_ocorrencia_bo", ("HORA_OCORRENCIA_BO",), "hour"),
    Field("desc_periodo", ("DESCR_PERIODO", "DESC_PERIODO"), "label"),
    Field("descr_tipolocal", ("DESCR_TIPOLOCAL",)),
    Field("descr_subtipolocal", ("DESCR_SUBTIPOLOCAL",)),
    Field("bairro", ("BAIRRO",)),
    Field("logradouro", ("LOGRADOURO",)),
    Field("numero_logradouro", ("NUMERO_LOGRADOURO",), "int"),
    Field("latitude", ("LATITUDE",), "coordinate"),
    Field("longitude", ("LONGITUDE",), "coordinate"),
    Field("rubrica", ("RUBRICA",)),
    Field("descr_conduta", ("DESCR_CONDUTA",)),
    Field("natureza_apurada", ("NATUREZA_APURADA",)),
    Field("nome_departamento", ("NOME_DEPARTAMENTO",)),
    Field("nome_seccional", ("NOME_SECCIONAL",)),
    Field("nome_delegacia", ("NOME_DELEGACIA",)),
    Field(
        "municipio_circunscricao",
        ("NOME_MUNICIPIO_CIRCUNSCRIÇÃO", "NOME_MUNICIPIO_CIRCUNSCRICAO"),
    ),
    Field("mes_estatistica", ("MES_ESTATISTICA",), "int"),
    Field("ano_estatistica", ("ANO_ESTATISTICA",), "int"),
    Field("cod_ibge", ("COD_IBGE",), "int"),
)

# Sentinels, labels, member, weekday names, bounds and counters.
# '(Vazio)' is a text sentinel because the source documents it as an empty cell.
INCIDENTS = CleaningRules(
    fields=INCIDENT_FIELDS,
    text_sentinels=("NULL", "", "(Vazio)"),
    hour_sentinels=("NULL", "", "-", "(Vazio)"),
    coordinate_sentinels=("NULL", "", "-", "(Vazio)"),
    labels={
        "DE MADRUGADA": "De madrugada",
        "PELA MANHA": "Pela manhã",
        "A TARDE": "A tarde",
        "A NOITE": "A noite",
        "EM HORA INCERTA": "Em hora incerta",
    },
    city_column="municipio",
    date_column="dt_ocorrencia_bo",
)

INCIDENT_STAR = StarRules(
    member="NÃO INFORMADO",
    type_keys=("rubrica", "natureza_apurada", "descr_tipolocal", "descr_subtipolocal"),
    weekday_names=("Domingo", "Segunda", "Terça", "Quarta", "Quinta", "Sexta", "Sábado"),
)

INCIDENT_QUALITY = QualityRules(
    date_floor=dt.date(2015, 1, 1),
    date_ceiling=dt.date(2026, 4, 30),
    lat_bounds=(-23.65, -23.35),
    lon_bounds=(-47.55, -47.30),
    unique_key=("num_bo", "ano_bo", "nome_delegacia"),
    sensitive_pattern="estupro|vulnerav|sexual",
    categories=("rubrica", "natureza_apurada", "bairro", "desc_periodo", "descr_tipolocal"),
    sentinel_counts={
        "lat_zero": ("LATITUDE", "0"),
        "lat_traco": ("LATITUDE", "-"),
        "lat_null_str": ("LATITUDE", "NULL"),
        "hora_null_str": ("HORA_OCORRENCIA_BO", "NULL"),
        "ibge_vazio": ("COD_IBGE", "(Vazio)"),
    },
)

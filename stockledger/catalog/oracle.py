"""The same results in plain SQL on the same tables, written apart from the operators.

`CTES` holds named building blocks in dependency order; `_sql` puts the ones a query needs in
front of it.
"""

from __future__ import annotations

import re

from stockledger import vocab

P3 = '"CodigoGenerico", "GrupoInventario", "Generico"'
PRODUCT_ORDER = '"GrupoInventario", "CodigoGenerico", "Generico"'
MONTHS = range(1, 13)


def _text(value: str | int | None) -> str:
    return "NULL" if value is None else f"'{value}'" if isinstance(value, str) else str(value)


def _in(values: list[str]) -> str:
    return "(" + ", ".join(_text(v) for v in values) + ")"


# fixed values, written out here so that a wrong sign of the operators does not pass: place, voucher, family, sign, monthly sign
_VOUCHERS = """
    (0, 'RMC - REGISTRO DE COMPRA FARMACIA', 'purchases', 1, CAST(NULL AS INT)),
    (1, 'DC - DEVOLUCION DE COMPRA', 'purchases', -1, CAST(NULL AS INT)),
    (2, 'EDO - ENTRADAS DONACIONES', 'purchases', 1, CAST(NULL AS INT)),
    (3, 'EAP - ENTRADAS POR APROVECHAMIENTO', 'purchases', 1, CAST(NULL AS INT)),
    (4, 'MIA - MOVIMIENTO INICIAL', 'initial', 1, CAST(NULL AS INT)),
    (5, 'MIS - MOVIMIENTO INICIAL DE SALIDA', 'initial', -1, CAST(NULL AS INT)),
    (6, 'EAS - ENTRADAS AJUSTES SOBRANTES', 'adjustments', 1, CAST(NULL AS INT)),
    (7, 'SAF - SALIDAS AJUSTES FALTANTES', 'adjustments', -1, CAST(NULL AS INT)),
    (8, 'EASC - ENTRADAS AJUSTES SOBRANTES CONTEO', 'adjustments', 1, CAST(NULL AS INT)),
    (9, 'SAFC - SALIDAS AJUSTES FALTANTES CONTEO', 'adjustments', -1, CAST(NULL AS INT)),
    (10, 'SPOE - SALIDAS POR PRESTAMOS A OTRAS ENTIDADES', 'lent', 1, CAST(NULL AS INT)),
    (11, 'EDP - ENTRADAS POR DEVOLUCION A PRESTAMOS', 'lent', -1, CAST(NULL AS INT)),
    (12, 'EPS - ENTRADAS PRESTAMOS SIIGO', 'lent', -1, CAST(NULL AS INT)),
    (13, 'EPOE - ENTRADAS POR PRESTAMOS DE OTRAS ENTIDADES', 'borrowed', 1, CAST(NULL AS INT)),
    (14, 'SDP - SALIDAS POR DEVOLUCION DE PRESTAMOS', 'borrowed', -1, CAST(NULL AS INT)),
    (15, 'SPS - SALIDAS PRESTAMOS SIIGO', 'borrowed', -1, CAST(NULL AS INT)),
    (16, 'ENTRADA POR TRASLADO', 'transfers', 1, CAST(NULL AS INT)),
    (17, 'SALIDA POR TRASLADO', 'transfers', -1, CAST(NULL AS INT)),
    (18, 'SDF - SISTEMA DISPENSACION FARMACIA', 'consumption', 1, 1),
    (19, 'SADF - SISTEMA ANULACION DISPENSACION FARMACIA', 'consumption', -1, -1),
    (20, 'SIN - SALIDAS INTERNAS FARMACIA', 'consumption', 1, 1),
    (21, 'SIA - SALIDAS INTERNAS ALMACEN', 'consumption', -1, 1),
    (22, 'EIS - ENTRADAS INTERNAS SIMA', 'consumption', -1, -1)"""
_CENTS = "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT)"
_UNIT = "CAST(0.0001 AS DECIMAL(5,4))"
_PERCENT = "(55 + (l_partkey % 12) * 10)"
_SERVICE = (
    "CASE l_suppkey % 5 WHEN 0 THEN 'consultas generales' WHEN 1 THEN 'consultas especializadas' "
    "WHEN 2 THEN 'pym' WHEN 3 THEN 'cronicos' ELSE 'servicio farmaceutico' END"
)
_ARTICLE = "CAST(1 + {k} % 4 AS VARCHAR) || lpad(CAST({k} AS VARCHAR), 12, '0')"
_SPECIALTY = (
    "CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'MEDICINA GENERAL' WHEN 'MACHINERY' THEN 'ODONTOLOGIA' "
    "WHEN 'FURNITURE' THEN 'ENFERMERIA' WHEN 'BUILDING' THEN 'ONCOLOGIA' WHEN 'AUTOMOBILE' THEN 'CARDIOLOGIA' END"
)
_GRAIN = (
    '"Comprobante", "Fecha", "NoDocumento", "Proveedor", "CentroCosto", "Dependencia", "Bodega", "Unidad", "User", '
    '"FechaDigitacion", "field_1", "Clasificacion_consumo", "Municipio", "Servicio", "Tipo_servicio", "Nombre", '
    '"CodGrupo", "Grupo", "CodigoGenerico", "EstadoArticulo"'
)
_BILL_GRAIN = (
    '"idadmision", "nofactura", "idusuario", "nomtiposervicio", "codigo", "billed_name", "Especialidad", "MedicoRealiza"'
)
_GRAIN_SUMS = (
    'CAST(SUM("Cantidad") AS BIGINT) AS "Cantidad", CAST(SUM("ValorUnitario") AS DOUBLE) / COUNT("ValorUnitario") AS "ValorUnitario", '
    'SUM("TotalBruto") AS "TotalBruto", SUM("ValorIVA") AS "ValorIVA", SUM("ValorDescuento") AS "ValorDescuento", '
    'SUM("ValorTotal") AS "ValorTotal"'
)


def _grain(voucher: str) -> str:
    return f"""
        SELECT {_GRAIN}, {_GRAIN_SUMS},
               CAST("field_1" AS VARCHAR) || '-' || CAST("CodigoGenerico" AS VARCHAR) AS "ADM-CodGen"
        FROM (SELECT f.*, l."Nombre", CAST(l."CodigoGenerico" AS BIGINT) AS "CodigoGenerico", l."EstadoArticulo"
              FROM fields f LEFT JOIN listing l ON f."CodArticulo" = l."Codigo"
              WHERE f."Comprobante" = '{voucher}')
        GROUP BY {_GRAIN}"""


def _corrected(source: str) -> str:
    entity = '"MedicoRealiza" IN (SELECT entidad FROM entities)'
    return f"""
        SELECT *, CASE
            WHEN "Servicio" = 'servicio farmaceutico' AND {entity} THEN 'servicio farmaceutico'
            WHEN "Servicio" = 'consultas generales' AND "Especialidad" NOT IN ('MEDICINA GENERAL', 'ODONTOLOGIA')
                 AND NOT ({entity}) THEN 'consultas especializadas'
            WHEN "Servicio" = 'consultas especializadas' AND "Especialidad" IN ('MEDICINA GENERAL', 'ODONTOLOGIA')
                 AND NOT ({entity}) THEN 'consultas generales'
            WHEN "Servicio" IN ('consultas especializadas', 'consultas generales') AND "Especialidad" = 'ENFERMERIA'
                 AND NOT ({entity}) THEN 'pym'
            WHEN "Especialidad" IN ('ONCOLOGIA', 'TERAPIAS ONCOLOGICAS') AND NOT ({entity}) THEN 'terapias oncologicas'
            ELSE "Servicio" END AS "Servicio_Corregido"
        FROM {source}"""


_SPECIALTY_FIXED = """CASE
    WHEN "Servicio_Corregido" IN ('pym', 'cronicos', 'terapias oncologicas', 'servicio farmaceutico') THEN "Servicio_Corregido"
    WHEN "Especialidad" = '' OR "Especialidad" IS NULL THEN "Servicio_Corregido"
    ELSE "Especialidad" END"""


def _class_side(source: str, sign: int, origin: str, service: str) -> str:
    return f"""
        SELECT '{origin}' AS "origen", {sign} AS "signo", "Clasificacion_consumo", "Municipio", {service} AS "Servicio",
               CAST(trunc(SUM("ValorTotal")) AS BIGINT) AS "ValorTotal"
        FROM {source} WHERE "Clasificacion_consumo" IN ('Medicamentos', 'Dispositivos Medicos', 'Suministros')
        GROUP BY ALL"""


CTES: dict[str, str] = {
    "vouchers": f'SELECT * FROM (VALUES {_VOUCHERS}) AS t(ix, voucher, family, sign, msign)',
    "entities": "SELECT c_name AS entidad FROM customer WHERE c_custkey % 20 = 0",
    "confirmed": """
        SELECT CAST(l_shipdate AS DATE) AS "Fecha", n_name AS "Bodega", l_partkey AS "CodigoGenerico",
               p_type AS "GrupoInventario", p_name AS "Generico", s_name AS "Tercero",
               COALESCE(voucher, 'OTR - OTRO MOVIMIENTO') AS "Comprobante_corregido", family, sign, msign,
               CAST(month(l_shipdate) AS BIGINT) AS "Mes",
               CAST(l_quantity AS BIGINT) AS q, CAST(l_extendedprice AS DECIMAL(18,2)) AS v
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
        JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
        LEFT JOIN vouchers ON (l_orderkey * 7 + l_linenumber) % 24 = ix
        WHERE o_orderstatus <> 'P'""",
    "net": f"""
        SELECT "Fecha", "Bodega", {P3}, "Tercero", "Mes", q AS "Cantidad_neta", v AS "ValorTotal_neto",
               CASE WHEN q = 0 THEN 0.0 ELSE round_even(CAST(v AS DOUBLE) / q * 100, 0) / 100 END AS price
        FROM (SELECT "Fecha", "Bodega", {P3}, "Tercero", "Mes",
                     CAST(SUM(CASE WHEN "Comprobante_corregido" LIKE 'RMC%' THEN q ELSE -q END) AS BIGINT) AS q,
                     SUM(CASE WHEN "Comprobante_corregido" LIKE 'RMC%' THEN v ELSE -v END) AS v
              FROM confirmed
              WHERE "Comprobante_corregido" IN ('RMC - REGISTRO DE COMPRA FARMACIA', 'DC - DEVOLUCION DE COMPRA')
              GROUP BY ALL)""",
    "used": f"""
        SELECT "Bodega", {P3}, "Mes", q * msign AS q, v * msign AS v FROM confirmed WHERE family = 'consumption'""",
    "extract": f"""
        SELECT CASE WHEN l_linenumber <= 3 THEN 'SISTEMA DISPENSACION FARMACIA'
                    WHEN l_linenumber = 4 THEN 'SISTEMA ANULACION DISPENSACION FARMACIA'
                    WHEN l_linenumber = 5 THEN 'SALIDAS INTERNAS ALMACEN'
                    WHEN l_linenumber = 6 THEN 'SALIDAS INTERNAS FARMACIA'
                    WHEN l_orderkey % 3 = 0 THEN 'ENTRADAS INTERNAS FARMACIA'
                    WHEN l_orderkey % 3 = 1 THEN 'ENTRADAS INTERNAS SIMA'
                    ELSE 'ENTRADAS INTERNAS ALMACEN' END AS "Comprobante",
               strftime(l_shipdate, '%d/%m/%Y') AS "Fecha",
               CASE WHEN l_orderkey % 50 = 49 THEN 'DOC SIN ADMISION'
                    ELSE 'DOC ADM: ' || CAST(l_orderkey AS VARCHAR) END AS "NoDocumento",
               s_name AS "Proveedor",
               lpad(CAST(s_nationkey AS VARCHAR), 3, '0') || {_SERVICE} || '-' ||
                   CASE l_suppkey % 2 WHEN 0 THEN 'AMB' ELSE 'HOS' END AS "CentroCosto",
               'DEP ' || CAST(l_suppkey % 10 AS VARCHAR) AS "Dependencia",
               'BODEGA ' || CAST(s_nationkey % 5 AS VARCHAR) AS "Bodega",
               'G' || CAST(l_partkey % 10 AS VARCHAR) AS "CodGrupo",
               'GRUPO ' || CAST(l_partkey % 10 AS VARCHAR) AS "Grupo",
               {_ARTICLE.format(k="l_partkey")} AS "CodArticulo",
               CAST(l_quantity AS BIGINT) AS "Cantidad",
               CAST(({_CENTS} * 100) // CAST(l_quantity AS BIGINT) AS DECIMAL(18,0)) * {_UNIT} AS "ValorUnitario",
               CAST(l_extendedprice AS DECIMAL(18,2)) AS "TotalBruto",
               CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS "ValorIVA",
               CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) AS "ValorDescuento",
               CAST(l_extendedprice AS DECIMAL(18,2)) AS "ValorTotal",
               'UND' AS "Unidad", 'USR' || CAST(l_linenumber AS VARCHAR) AS "User",
               strftime(l_shipdate, '%d/%m/%Y') AS "FechaDigitacion"
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    "fields": """
        SELECT *, COALESCE(TRY_CAST(trim(split_part("NoDocumento", 'ADM: ', 2)) AS INTEGER), 0) AS "field_1",
               CASE left("CodArticulo", 1) WHEN '1' THEN 'Medicamentos' WHEN '2' THEN 'Dispositivos Medicos'
                    WHEN '3' THEN 'Suministros' ELSE 'OTRO' END AS "Clasificacion_consumo",
               left("CentroCosto", 3) AS "Municipio",
               trim(split_part(substr("CentroCosto", 4), '-', 1)) AS "Servicio",
               trim(split_part("CentroCosto", '-', 2)) AS "Tipo_servicio"
        FROM extract""",
    "listing": f"""
        SELECT {_ARTICLE.format(k="p_partkey")} AS "Codigo", p_name AS "Nombre",
               CAST(p_partkey AS VARCHAR) AS "CodigoGenerico",
               CASE WHEN p_size % 10 = 0 THEN 'INACTIVO' ELSE 'ACTIVO' END AS "EstadoArticulo"
        FROM part""",
    "bill_text": """
        SELECT CAST(l_quantity AS BIGINT) AS q, l_partkey % 101 = 0 AS wide, l_orderkey % 97 = 0 AS no_qty,
               l_orderkey % 89 = 0 AS no_value
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        WHERE l_partkey % 11 <> 0""",
    "billing": f"""
        SELECT l_orderkey AS "idadmision",
               'F' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber % 2 AS VARCHAR) AS "nofactura",
               'CC' || CAST(c_custkey AS VARCHAR) AS "idusuario",
               CASE WHEN l_linenumber <= 4 THEN 'FARMACIA' ELSE 'LABORATORIO' END AS "nomtiposervicio",
               CAST(l_partkey AS VARCHAR) AS "codigo", 'ART ' || CAST(l_partkey AS VARCHAR) AS "billed_name",
               CAST(l_quantity AS BIGINT) AS bq, CAST(l_quantity AS BIGINT) + 1 AS rq,
               CAST(({_CENTS} * {_PERCENT}) // CAST(l_quantity AS BIGINT) AS DECIMAL(18,0)) * {_UNIT} AS bp,
               CAST({_CENTS} * {_PERCENT} AS DECIMAL(18,0)) * {_UNIT} AS bv,
               {_SPECIALTY} AS "Especialidad", CASE WHEN o_orderstatus <> 'P' THEN c_name END AS "MedicoRealiza",
               l_partkey, l_suppkey
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        WHERE l_partkey % 11 <> 0""",
    "bill": f"""
        SELECT {_BILL_GRAIN}, CAST(SUM(bq) AS BIGINT) AS "billed_qty", CAST(SUM(rq) AS BIGINT) AS "requested_qty",
               CAST(SUM(bp) AS DOUBLE) / COUNT(bp) AS "billed_unit_price", SUM(bv) AS "billed_value",
               substr("idusuario", 3, 20) AS "# Identificacion",
               CAST("idadmision" AS VARCHAR) || '-' || "codigo" AS "ADM-CodGen"
        FROM billing WHERE "nomtiposervicio" = 'FARMACIA' GROUP BY {_BILL_GRAIN}""",
    "dispensed": _grain(vocab.DISPENSED),
    "returned": _grain(vocab.RETURNED),
    "with_billing": """
        SELECT d.*, b.* EXCLUDE ("ADM-CodGen") FROM dispensed d LEFT JOIN bill b ON d."ADM-CodGen" = b."ADM-CodGen" """,
    "corrected": _corrected("with_billing"),
    "billed": """
        SELECT * REPLACE (CASE WHEN "Servicio_Corregido" IN ('consultas generales', 'consultas especializadas')
                               THEN "Especialidad" ELSE "Servicio_Corregido" END AS "Especialidad")
        FROM corrected""",
    "people": 'SELECT DISTINCT "idadmision" AS adm, "Especialidad", "MedicoRealiza" FROM bill',
    "placed": 'SELECT r.*, p."Especialidad", p."MedicoRealiza" FROM returned r LEFT JOIN people p ON r."field_1" = p.adm',
    "placed_corrected": _corrected("placed"),
    "returns": """
        SELECT r.*, b.* EXCLUDE ("ADM-CodGen", "Especialidad", "MedicoRealiza"),
               b."Especialidad" AS "Especialidad_right", b."MedicoRealiza" AS "MedicoRealiza_right"
        FROM placed_corrected r LEFT JOIN bill b ON r."ADM-CodGen" = b."ADM-CodGen" """,
    "internal_out": f"""SELECT * FROM fields WHERE "Comprobante" IN {_in(vocab.INTERNAL_OUT)}""",
    "internal_in": f"""SELECT * FROM fields WHERE "Comprobante" IN {_in(vocab.INTERNAL_IN)}""",
    "class_totals": " UNION ALL ".join(
        [
            _class_side("internal_out", 1, "internal", '"Servicio"'),
            _class_side("internal_in", -1, "internal", '"Servicio"'),
            _class_side("billed", 1, "billed", _SPECIALTY_FIXED),
            _class_side("returns", -1, "billed", _SPECIALTY_FIXED),
        ]
    ),
    "lines": """
        SELECT f.*, l."Nombre", CAST(l."CodigoGenerico" AS BIGINT) AS "CodigoGenerico"
        FROM fields f LEFT JOIN listing l ON f."CodArticulo" = l."Codigo" """,
    "lines_out": f"""SELECT * FROM lines WHERE "Comprobante" IN {_in([vocab.DISPENSED, *vocab.INTERNAL_OUT])}""",
    "lines_in": f"""SELECT * FROM lines WHERE "Comprobante" IN {_in([vocab.RETURNED, *vocab.INTERNAL_IN])}""",
    "site_billing": f"""
        SELECT b.*, l_partkey AS "CodigoGenerico", p_name AS "Nombre",
               lpad(CAST(s_nationkey AS VARCHAR), 3, '0') AS "Municipio", {_SERVICE} AS "Servicio",
               {_SERVICE} AS "Servicio_Corregido"
        FROM billing b JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
        WHERE "nomtiposervicio" = 'FARMACIA'""",
    "stock_c": """
        SELECT "Municipio", "Servicio", "Clasificacion_consumo", "CodigoGenerico", "Nombre", SUM("ValorTotal") AS v,
               CAST(SUM("Cantidad") AS BIGINT) AS q, CAST(SUM("ValorUnitario") AS DOUBLE) / COUNT("ValorUnitario") AS p
        FROM lines_out GROUP BY ALL""",
    "stock_r": """
        SELECT "Municipio", "Servicio", "Clasificacion_consumo", "CodigoGenerico", "Nombre", SUM("ValorTotal") AS v,
               CAST(SUM("Cantidad") AS BIGINT) AS q, CAST(SUM("ValorUnitario") AS DOUBLE) / COUNT("ValorUnitario") AS p
        FROM lines_in GROUP BY ALL""",
    "stock_both": """
        SELECT c."Municipio", c."Servicio", c."Clasificacion_consumo", COALESCE(c."CodigoGenerico", 0) AS "CodigoGenerico",
               c."Nombre", r."Municipio" AS "Municipio_right", r."Servicio" AS "Servicio_right",
               r."Clasificacion_consumo" AS "Clasificacion_consumo_right",
               COALESCE(r."CodigoGenerico", 0) AS "CodigoGenerico_right", r."Nombre" AS "Nombre_right",
               COALESCE(c.v, 0) AS cv, COALESCE(c.q, 0) AS cq, COALESCE(c.p, 0) AS cp,
               COALESCE(r.v, 0) AS rv, COALESCE(r.q, 0) AS rq, COALESCE(r.p, 0) AS rp
        FROM stock_c c FULL JOIN stock_r r
        ON c."Municipio" = r."Municipio" AND c."Servicio" = r."Servicio"
           AND c."Clasificacion_consumo" = r."Clasificacion_consumo"
           AND c."CodigoGenerico" = r."CodigoGenerico" AND c."Nombre" = r."Nombre" """,
    "stock": """
        SELECT * EXCLUDE (cv, cq, cp, rv, rq, rp),
               CAST(cv AS DOUBLE) AS "Consumo_Valor", cq AS "Consumo_Cantidad", cp AS "Costo_Promedio_Consumo",
               CAST(rv AS DOUBLE) AS "Entradas_Valor", rq AS "Entradas_Cantidad", rp AS "Costo_Promedio_Entrada",
               CAST(cv AS DOUBLE) AS "Consumo_Neto_Valor", cq AS "Consumo_Neto_Cantidad",
               CAST(rv AS DOUBLE) AS "Compras_Totales_Valor", rq AS "Compras_Totales_Cantidad",
               CASE WHEN rv > 0 THEN CAST(cv AS DOUBLE) / CAST(rv AS DOUBLE) END AS "Ratio_Eficiencia_Valor",
               CASE WHEN rq > 0 THEN CAST(cq AS DOUBLE) / CAST(rq AS DOUBLE) END AS "Ratio_Eficiencia_Cantidad",
               cv - rv AS dv, cq - rq AS "Diferencia_Cantidad", cp - rp AS "Diff_Costo_Unitario",
               CASE WHEN cv > rv THEN 'DESABASTECIMIENTO' WHEN rv <= 0 THEN 'SIN_COMPRAS'
                    WHEN CAST(cv AS DOUBLE) / CAST(rv AS DOUBLE) < 0.5 THEN 'SOBRE_STOCK_CRITICO'
                    WHEN CAST(cv AS DOUBLE) / CAST(rv AS DOUBLE) < 0.7 THEN 'SOBRE_STOCK'
                    WHEN CAST(cv AS DOUBLE) / CAST(rv AS DOUBLE) < 0.9 THEN 'STOCK_ELEVADO'
                    ELSE 'OPTIMO' END AS "Estado_Inventario",
               CASE WHEN cv < rv THEN rv - cv ELSE 0 END AS dead,
               CASE WHEN cp - rp < -0.05 THEN 'COMPRA_CARA' WHEN cp - rp > 0.05 THEN 'CONSUMO_CARO' ELSE 'NORMAL' END
                   AS "Alerta_Costo_Unitario"
        FROM stock_both""",
    "gap_f": """
        SELECT "idadmision", "CodigoGenerico", "Nombre", SUM(bv) AS bv, CAST(SUM(bq) AS BIGINT) AS bq,
               CAST(SUM(bp) AS DOUBLE) / COUNT(bp) AS bp
        FROM site_billing GROUP BY ALL""",
    "gap_first": """
        SELECT * FROM (SELECT "idadmision" AS a, "CodigoGenerico" AS c, "Nombre" AS n, "Especialidad", "Servicio_Corregido",
                              "Municipio", "MedicoRealiza", "nofactura" AS "No_Factura",
                              row_number() OVER (PARTITION BY "idadmision", "CodigoGenerico", "Nombre"
                                  ORDER BY "nofactura" NULLS FIRST, "Especialidad" NULLS FIRST,
                                  "Servicio_Corregido" NULLS FIRST, "Municipio" NULLS FIRST, "MedicoRealiza" NULLS FIRST) AS rn
                       FROM site_billing) WHERE rn = 1""",
    "gap_c": """
        SELECT CAST("field_1" AS BIGINT) AS "idadmision", "CodigoGenerico", "Nombre", SUM("ValorTotal") AS v,
               CAST(SUM("Cantidad") AS BIGINT) AS q, CAST(SUM("ValorUnitario") AS DOUBLE) / COUNT("ValorUnitario") AS p
        FROM lines_out GROUP BY ALL""",
    "gap_both": """
        SELECT f."idadmision" AS fa, f."CodigoGenerico" AS fc, f."Nombre" AS fn,
               c."idadmision" AS ca, c."CodigoGenerico" AS cc, c."Nombre" AS cn,
               COALESCE(bv, 0) AS bv, COALESCE(bq, 0) AS bq, COALESCE(bp, 0) AS bp,
               COALESCE(v, 0) AS v, COALESCE(q, 0) AS q, COALESCE(p, 0) AS p,
               g."Especialidad", g."Servicio_Corregido", g."Municipio", g."MedicoRealiza", g."No_Factura"
        FROM gap_f f FULL JOIN gap_c c ON f."idadmision" = c."idadmision"
             AND f."CodigoGenerico" = c."CodigoGenerico" AND f."Nombre" = c."Nombre"
        LEFT JOIN gap_first g ON f."idadmision" = g.a AND f."CodigoGenerico" = g.c AND f."Nombre" = g.n""",
    "gap_ratio": """
        SELECT *, CASE WHEN v > 0 THEN CAST(bv AS DOUBLE) / CAST(v AS DOUBLE) END AS share,
               CASE WHEN bv > 0 THEN CAST(bv - v AS DOUBLE) / CAST(bv AS DOUBLE) * 100 END AS pct
        FROM gap_both""",
    "gap": """
        SELECT *, CASE WHEN bv = 0 THEN 'SIN_FACTURAR' WHEN v = 0 THEN 'FACTURADO_SIN_CONSUMO'
                       WHEN share IS NULL THEN 'INDETERMINADO' WHEN share < 0.7 THEN 'SUB_FACTURACION_CRITICA'
                       WHEN share < 0.9 THEN 'SUB_FACTURACION' WHEN share <= 1.1 THEN 'EQUILIBRADO'
                       WHEN share <= 1.5 THEN 'SOBRE_FACTURACION' ELSE 'SOBRE_FACTURACION_CRITICA' END AS state,
               CASE WHEN abs(bp - p) > p * 0.5 THEN 'SPREAD_ANOMALO' ELSE 'NORMAL' END AS spread
        FROM gap_ratio""",
    "bought_lines": """SELECT * FROM lines_in WHERE regexp_matches(lower("Comprobante"), 'compra|entrada')""",
    "bought_supplier": """
        SELECT * FROM (SELECT "CodigoGenerico" AS c, "Nombre" AS n, "Municipio" AS m, "Servicio" AS s, "Proveedor" AS prov,
                              row_number() OVER (PARTITION BY "CodigoGenerico", "Nombre", "Municipio", "Servicio"
                                                 ORDER BY COUNT(*) DESC, "Proveedor" NULLS FIRST) AS rn
                       FROM bought_lines GROUP BY "CodigoGenerico", "Nombre", "Municipio", "Servicio", "Proveedor")
        WHERE rn = 1""",
    "bought": """
        SELECT "CodigoGenerico", "Nombre", "Municipio", "Servicio",
               CAST(SUM("ValorUnitario") AS DOUBLE) / COUNT("ValorUnitario") AS pp,
               median(CAST("ValorUnitario" AS DOUBLE)) AS pm, CAST(MIN("ValorUnitario") AS DOUBLE) AS pmin,
               CAST(MAX("ValorUnitario") AS DOUBLE) AS pmax, CAST(SUM("Cantidad") AS BIGINT) AS bq, SUM("ValorTotal") AS bv,
               COUNT(DISTINCT "Proveedor") + MAX(CASE WHEN "Proveedor" IS NULL THEN 1 ELSE 0 END) AS ns
        FROM bought_lines GROUP BY ALL""",
    "sold": """
        SELECT "CodigoGenerico", "Nombre", "Municipio", "Servicio", CAST(SUM(bp) AS DOUBLE) / COUNT(bp) AS sp,
               median(CAST(bp AS DOUBLE)) AS sm, SUM(bv) AS sv, CAST(SUM(bq) AS BIGINT) AS sq
        FROM site_billing GROUP BY ALL""",
    "consumed": """
        SELECT "CodigoGenerico", "Nombre", "Municipio", "Servicio",
               CAST(SUM("ValorUnitario") AS DOUBLE) / COUNT("ValorUnitario") AS cp,
               CAST(SUM("Cantidad") AS BIGINT) AS cq, SUM("ValorTotal") AS cv
        FROM lines_out GROUP BY ALL""",
    "margin_base": """
        SELECT b."CodigoGenerico", b."Nombre", b."Municipio", b."Servicio", pp, COALESCE(pm, 0) AS pm, pmin, pmax, bq, bv, ns,
               prov, COALESCE(sp, 0) AS sp, COALESCE(sm, 0) AS sm, COALESCE(sv, 0) AS sv, COALESCE(sq, 0) AS sq,
               COALESCE(cp, 0) AS cp, COALESCE(cq, 0) AS cq, COALESCE(cv, 0) AS cv
        FROM bought b LEFT JOIN bought_supplier x ON b."CodigoGenerico" = c AND b."Nombre" = n AND b."Municipio" = m AND b."Servicio" = s
        LEFT JOIN sold USING ("CodigoGenerico", "Nombre", "Municipio", "Servicio")
        LEFT JOIN consumed USING ("CodigoGenerico", "Nombre", "Municipio", "Servicio")""",
    "margin_ratios": """
        SELECT *, CASE WHEN pp > 0 THEN (sp - pp) / pp * 100 END AS pct,
               CASE WHEN bq > 0 THEN CAST(cq AS DOUBLE) / CAST(bq AS DOUBLE) END AS used_share,
               CASE WHEN bq > 0 THEN CAST(sq AS DOUBLE) / CAST(bq AS DOUBLE) END AS sold_share,
               greatest(bq - cq, 0) * pp AS dead
        FROM margin_base""",
    "margins": """
        SELECT *, CASE WHEN pct IS NULL THEN 'SIN_VENTA' WHEN pct < 0 THEN 'PERDIDA' WHEN pct < 10 THEN 'MARGEN_BAJO'
                       WHEN pct < 30 THEN 'MARGEN_NORMAL' ELSE 'MARGEN_ALTO' END AS a_margin,
               CASE WHEN bq = 0 THEN 'SIN_COMPRA' WHEN used_share IS NULL THEN 'SIN_CONSUMO'
                    WHEN used_share < 0.5 THEN 'SOBRE_COMPRA_CRITICA' WHEN used_share < 0.8 THEN 'SOBRE_COMPRA'
                    WHEN used_share <= 1.1 THEN 'OPTIMO' ELSE 'DESABASTECIMIENTO' END AS a_buy,
               CASE WHEN sold_share IS NULL THEN 'SIN_VENTA' WHEN sold_share < 0.7 THEN 'BAJA_ROTACION_VENTA'
                    WHEN sold_share <= 1.2 THEN 'NORMAL' ELSE 'VENTA_SUPERIOR_COMPRA' END AS a_turn
        FROM margin_ratios""",
}


# the financial report on the prepared datasets, as the consumption job makes it
COMPOSED: dict[str, str] = {
    **CTES,
    "lines_out": "SELECT * FROM billed UNION ALL BY NAME SELECT * FROM internal_out",
    "lines_in": "SELECT * FROM returns UNION ALL BY NAME SELECT * FROM internal_in",
    "site_billing": 'SELECT *, "billed_value" AS bv, "billed_qty" AS bq, "billed_unit_price" AS bp FROM billed',
    # products without a code are a group with a first row of its own
    "gap_f": CTES["gap_f"].replace("SUM(bv) AS bv", "true AS billed_here, SUM(bv) AS bv"),
    "gap_both": CTES["gap_both"].replace(
        """f."idadmision" = g.a AND f."CodigoGenerico" = g.c AND f."Nombre" = g.n""",
        """billed_here AND f."idadmision" IS NOT DISTINCT FROM g.a
               AND f."CodigoGenerico" IS NOT DISTINCT FROM g.c AND f."Nombre" IS NOT DISTINCT FROM g.n""",
    ),
}


def _sql(body: str, blocks: dict[str, str] = CTES) -> str:
    """The query with the building blocks it mentions, directly or through others."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in blocks:
            if name not in needed and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                needed.add(name)
                visit(blocks[name])

    visit(body)
    if not needed:
        return body.strip()
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in blocks.items() if name in needed)
    return f"WITH {ctes}\n{body.strip()}"


# --- ledger ----------------------------------------------------------------------------------


def _net_family(family: str) -> str:
    vouchers = vocab.family_vouchers(family)
    cells = [
        f'CAST(COALESCE(SUM(CASE WHEN "Comprobante_corregido" = {_text(v)} THEN {m} END), 0) AS {t}) AS "{name}_{v}"'
        for name, m, t in (("Cantidad", "q", "BIGINT"), ("ValorTotal", "v", "DOUBLE"))
        for v in vouchers
    ]
    index = f'{P3}, "Bodega", "Tercero", "Comprobante_corregido"'
    return _sql(
        f"""SELECT strftime("Fecha", '%Y-%m-%d') AS "Fecha", {index}, {", ".join(cells)}
            FROM confirmed WHERE family = '{family}' GROUP BY "Fecha", {index}"""
    )


def _movement(keys: str, families: list[str]) -> str:
    cells = [
        f"CAST(COALESCE(SUM(CASE WHEN family = '{f}' THEN {m} * sign END), 0) AS {t}) AS \"{name}_total_{vocab.FAMILY_WORDS[f]}\""
        for f in families
        for name, m, t in (("Cantidad", "q", "BIGINT"), ("ValorTotal", "v", "DOUBLE"))
    ]
    return _sql(f"SELECT {keys}, {', '.join(cells)} FROM confirmed WHERE family IN {_in(families)} GROUP BY {keys}")


def _loan(family: str, quantity: str, value: str) -> str:
    keys = f'"Bodega", {P3}, "Tercero"'
    return _sql(
        f"""SELECT {keys}, CAST(SUM(q * sign) AS BIGINT) AS "{quantity}", CAST(SUM(v * sign) AS DOUBLE) AS "{value}"
            FROM confirmed WHERE family = '{family}' GROUP BY {keys}"""
    )


_PRICES = """CAST(SUM("Cantidad_neta") AS BIGINT) AS "cantidad_comprada_neta",
    CAST(SUM("ValorTotal_neto") AS DOUBLE) AS "valor_total_comprado_neto",
    CAST(SUM(CAST(price AS DECIMAL(18,2))) AS DOUBLE) / COUNT(price) AS "valor_unitario_calculado_promedio",
    MAX(price) AS "valor_unitario_calculado_maximo", MIN(price) AS "valor_unitario_calculado_minimo" """


def _monthly_purchases() -> str:
    cells = []
    for m in MONTHS:
        here = f'FILTER (WHERE "Mes" = {m})'
        cells += [
            f'COALESCE(CAST(SUM(CAST(price AS DECIMAL(18,2))) {here} AS DOUBLE) / NULLIF(COUNT(price) {here}, 0), 0) AS "{m}"',
            f'CAST(COALESCE(SUM("Cantidad_neta") {here}, 0) AS BIGINT) AS "Cantidad_neta_{m}"',
            f'CAST(COALESCE(SUM("ValorTotal_neto") {here}, 0) AS DOUBLE) AS "ValorTotal_neto_{m}"',
        ]
    cells += [f'COUNT(*) FILTER (WHERE "Mes" = {m}) AS "{m}_cant_registros"' for m in MONTHS]
    return _sql(f"SELECT {PRODUCT_ORDER}, {', '.join(cells)} FROM net GROUP BY {PRODUCT_ORDER}")


def _month_cells(measure: str, kind: str) -> str:
    return ", ".join(f'COALESCE(SUM({measure}) FILTER (WHERE "Mes" = {m}), 0) AS m{m}' for m in MONTHS)


def _months_out(kind: str) -> str:
    return ", ".join(f'CAST(m{m} AS {kind}) AS "{m}"' for m in MONTHS)


_ALL_MONTHS = "(" + " + ".join(f"m{m}" for m in MONTHS) + ")"
_MONTH_LIST = ", ".join(f"m{m}" for m in MONTHS)


def _monthly(measure: str, kind: str, total: str, suffix: str) -> str:
    return _sql(
        f"""SELECT {P3}, {_months_out(kind)}, CAST({_ALL_MONTHS} AS {kind}) AS "{total}",
                   CAST({_ALL_MONTHS} AS DOUBLE) / 12 AS "Promedio_{suffix}",
                   CAST(least({_MONTH_LIST}) AS {kind}) AS "Minimo_{suffix}",
                   CAST(greatest({_MONTH_LIST}) AS {kind}) AS "Maximo_{suffix}"
            FROM (SELECT {P3}, {_month_cells(measure, kind)} FROM used GROUP BY {P3})"""
    )


_VARIABILITY = f"""
    SELECT "Bodega", {P3}, {_months_out("BIGINT")}, avg_q AS "Promedio_Mensual",
           round(sd, 6) AS "Desviacion_Estandar", round(cv, 6) AS "Coeficiente_Variacion",
           CASE WHEN cv <= 0.25 THEN 'Estable' WHEN cv <= 0.50 THEN 'Variable' ELSE 'Erratica' END AS "Tipo_Demanda"
    FROM (SELECT *, CASE WHEN avg_q > 0 THEN sd / avg_q ELSE 0 END AS cv
          FROM (SELECT w.*, CAST({_ALL_MONTHS} AS DOUBLE) / 12 AS avg_q
                FROM (SELECT "Bodega", {P3}, {_month_cells("q", "BIGINT")},
                             COALESCE(stddev_samp(q), 0) AS sd
                      FROM (SELECT "Bodega", {P3}, "Mes", CAST(SUM(q) AS BIGINT) AS q FROM used GROUP BY ALL)
                      GROUP BY "Bodega", {P3}) w))"""

_LEDGER = {
    "ledger_prepare": """
        SELECT CAST(year("Fecha") AS BIGINT) AS "Año", "Mes", CAST(day("Fecha") AS BIGINT) AS "Dia", "Comprobante_corregido",
               COUNT(*) AS n, CAST(SUM(q) AS BIGINT) AS qty, CAST(SUM(v) AS DOUBLE) AS val,
               strftime(MIN("Fecha"), '%Y-%m-%d') AS first_day
        FROM confirmed GROUP BY ALL""",
    "voucher_family_counts": 'SELECT family, COUNT(*) AS "registros" FROM confirmed GROUP BY family',
    "unclassified_count": 'SELECT COUNT(*) AS "pendientes" FROM confirmed WHERE family IS NULL',
    "net_purchases": f"""
        SELECT strftime("Fecha", '%Y-%m-%d') AS "Fecha", "Bodega", {P3}, "Tercero", "Mes", "Cantidad_neta",
               CAST("ValorTotal_neto" AS DOUBLE) AS "ValorTotal_neto", price AS "valor_unitario_calculado" FROM net""",
    "purchases_by_supplier": f"""
        SELECT strftime("Fecha", '%Y-%m-%d') AS "Fecha", "Mes", "Bodega", {P3}, "Tercero",
               SUM(price) AS "suma valor unitario", COUNT(price) AS "cantidad compras",
               MIN(price) AS "valor unitario minimo", MAX(price) AS "valor unitario maximo",
               AVG(price) AS "valor unitario promedio"
        FROM net GROUP BY "Fecha", "Mes", "Bodega", {P3}, "Tercero" """,
    "largest_purchases": f"""
        SELECT {P3}, "Tercero", {_PRICES}, COUNT(price) AS "cantidad_registros" FROM net GROUP BY {P3}, "Tercero" """,
    "most_purchased": f"""
        SELECT {P3}, {_PRICES}, COUNT("Tercero") AS "cantidad_proveedores" FROM net GROUP BY {P3}""",
    "abc_pareto": f"""
        SELECT {P3}, CAST(t AS DOUBLE) AS "Valor_Total_Consumido",
               CASE WHEN s > 0 THEN CAST(t AS DOUBLE) / CAST(s AS DOUBLE) ELSE 0 END AS "Porcentaje_Participacion",
               CASE WHEN s > 0 THEN CAST(c AS DOUBLE) / CAST(s AS DOUBLE) ELSE 0 END AS "Porcentaje_Acumulado",
               CASE WHEN s <= 0 THEN 'C' WHEN CAST(c AS DOUBLE) / CAST(s AS DOUBLE) <= 0.80 THEN 'A'
                    WHEN CAST(c AS DOUBLE) / CAST(s AS DOUBLE) <= 0.95 THEN 'B' ELSE 'C' END AS "Clasificacion_ABC"
        FROM (SELECT {P3}, t, SUM(t) OVER () AS s,
                     SUM(t) OVER (ORDER BY t DESC, {P3} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c
              FROM (SELECT {P3}, SUM(v) AS t FROM used GROUP BY {P3}))""",
    "demand_variability": _VARIABILITY,
    "consumption_by_warehouse": f"""
        SELECT "Bodega", {P3}, {_months_out("BIGINT")}, CAST({_ALL_MONTHS} AS BIGINT) AS "Total_Cantidad",
               CAST({_ALL_MONTHS} AS DOUBLE) / 12 AS "Promedio_Mensual"
        FROM (SELECT "Bodega", {P3}, {_month_cells("q", "BIGINT")} FROM used GROUP BY "Bodega", {P3})""",
}

# --- consumption -----------------------------------------------------------------------------

_MONEY_OUT = (
    'REPLACE (CAST("TotalBruto" AS DOUBLE) AS "TotalBruto", CAST("ValorIVA" AS DOUBLE) AS "ValorIVA", '
    'CAST("ValorDescuento" AS DOUBLE) AS "ValorDescuento", CAST("ValorTotal" AS DOUBLE) AS "ValorTotal", '
    'CAST("field_1" AS BIGINT) AS "field_1"{more})'
)
_GRAIN_OUT = _MONEY_OUT.format(more="")
_BILLED_OUT = _MONEY_OUT.format(
    more="".join(f', CAST("{c}" AS DOUBLE) AS "{c}"' for c in ("billed_value", "billed_qty", "requested_qty", "idadmision"))
)
_CORRECTED_OUT = (
    '"ADM-CodGen", "Comprobante", "CentroCosto", "Servicio", "Especialidad", "MedicoRealiza", "Servicio_Corregido", '
    'CAST("ValorTotal" AS DOUBLE) AS "ValorTotal"'
)
_AUDIT_RULES = {
    1: """"Servicio" = 'consultas generales' AND "Especialidad" NOT IN ('MEDICINA GENERAL', 'ODONTOLOGIA')""",
    2: """"Servicio" = 'consultas especializadas' AND "Especialidad" IN ('MEDICINA GENERAL', 'ODONTOLOGIA', 'HIGIENE ORAL')""",
    3: """"Servicio" = 'pym' AND "Especialidad" NOT IN ('MEDICINA GENERAL', 'ODONTOLOGIA', 'HIGIENE ORAL',
          'ENFERMERIA', 'GINECOLOGIA', 'EXPERTO EN VIH')""",
    4: """"Servicio" = 'cronicos' AND "Especialidad" NOT IN ('MEDICINA INTERNA', 'MEDICINA GENERAL', 'ENDOCRINOLOGIA',
          'MEDICINA FAMILIAR', 'CARDIOLOGIA', 'NEFROLOGIA', 'ENFERMERIA')""",
    5: """"Servicio" = 'servicio farmaceutico' AND "MedicoRealiza" NOT IN (SELECT entidad FROM entities)""",
}


def _audit(rule: int) -> str:
    return f"""
        SELECT "CentroCosto", "Especialidad", "MedicoRealiza", COUNT("CentroCosto") AS "Cantidad Registros"
        FROM billed WHERE {_AUDIT_RULES[rule]} GROUP BY "CentroCosto", "Especialidad", "MedicoRealiza" """


def _net_report(article_class: str, origins: list[str]) -> str:
    return f"""
        SELECT "Municipio", "Servicio", CAST(SUM("signo" * "ValorTotal") AS BIGINT) AS "ValorNeto" FROM class_totals
        WHERE "Clasificacion_consumo" = '{article_class}' AND "origen" IN {_in(origins)} GROUP BY "Municipio", "Servicio" """


def _raw_total(vouchers: list[str]) -> str:
    return f"""(SELECT SUM("ValorTotal") FROM extract WHERE "Comprobante" IN {_in(vouchers)})"""


def _control(name: str, source: str, columns: int) -> str:
    return f"""SELECT '{name}' AS "conjunto", COUNT(*) AS "filas", CAST({columns} AS BIGINT) AS "columnas",
                      CAST(SUM("ValorTotal") AS DOUBLE) AS "ValorTotal" FROM {source}"""


_CONSUMPTION = {
    "movement_fields": """
        SELECT "Clasificacion_consumo", "Municipio", "Servicio", "Tipo_servicio", COUNT(*) AS n,
               CAST(SUM("field_1") AS BIGINT) AS admissions, COUNT(*) FILTER (WHERE "field_1" = 0) AS without_admission
        FROM fields GROUP BY ALL""",
    "extract_quality": """
        SELECT COUNT(*) FILTER (WHERE NOT contains("CentroCosto", '-')) AS "sin_tipo_servicio",
               COUNT(*) FILTER (WHERE "field_1" = 0) AS "sin_admision" FROM fields""",
    "product_listing": "SELECT * FROM listing",
    "billing_by_admission": 'SELECT * REPLACE (CAST("billed_value" AS DOUBLE) AS "billed_value") FROM bill',
    "dispensed_grain": f"SELECT * {_GRAIN_OUT} FROM dispensed",
    "returns_grain": f"SELECT * {_GRAIN_OUT} FROM returned",
    "consumption_with_billing": f"SELECT * {_BILLED_OUT} FROM with_billing",
    "returns_attributed": f"SELECT * {_BILLED_OUT} FROM returns",
    "corrected_service": f"SELECT {_CORRECTED_OUT} FROM corrected",
    "specialty_override": f"SELECT {_CORRECTED_OUT} FROM billed",
    "unclosed_billing": f"""
        SELECT * {_MONEY_OUT.format(more="").replace(', CAST("field_1" AS BIGINT) AS "field_1"', "")}
        FROM (SELECT "Comprobante", "Fecha", "CentroCosto", "Dependencia", "Bodega", "CodGrupo", "Grupo", "codigo", "Nombre",
                     "Cantidad", "ValorUnitario", "TotalBruto", "ValorIVA", "ValorDescuento", "ValorTotal", "ADM-CodGen",
                     CAST("idadmision" AS DOUBLE) AS "idadmision", "nofactura", "idusuario", "nomtiposervicio", "Servicio"
              FROM corrected WHERE "MedicoRealiza" IS NULL)""",
    "control_totals": " UNION ALL ".join(
        [
            _control("billed", "billed", 41),
            _control("unclosed", 'corrected WHERE "MedicoRealiza" IS NULL', 21),
            _control("billed_clean", "billed", 41),
            _control("internal_out", "internal_out", 25),
            _control("returns", "returns", 43),
            _control("internal_in", "internal_in", 25),
            _control("profitability_input", "with_billing", 40),
        ]
    ),
    "audit_all": " UNION ALL ".join(_audit(r) for r in _AUDIT_RULES),
    **{f"audit_rule_{r}": _audit(r) for r in _AUDIT_RULES},
    "quantity_deviations": """
        SELECT "Comprobante", "Fecha", "NoDocumento", "CentroCosto", "Dependencia", "Bodega", "CodGrupo", "Grupo",
               b."CodigoGenerico", "Nombre", "Cantidad", CAST("ValorTotal" AS DOUBLE) AS "ValorTotal",
               moda AS "Cantidad_moda", maximo AS "Cantidad_maximo", round(media, 6) AS "Cantidad_media",
               round(sd, 6) AS "Cantidad_std", minimo AS "Cantidad_minimo",
               abs("Cantidad" - moda) AS "Desviacion_moda", round(abs("Cantidad" - media), 6) AS "Desviacion_media",
               round(abs("Cantidad" - sd), 6) AS "Desviacion_std", abs("Cantidad" - maximo) AS "Desviacion_maximo",
               abs("Cantidad" - minimo) AS "Desviacion_minimo", 'ALERTA' AS "Alerta_desviacion_moda",
               CASE WHEN abs("Cantidad" - media) > 1e-6 THEN 'ALERTA' ELSE 'OK' END AS "Alerta_desviacion_media",
               CASE WHEN abs("Cantidad" - sd) > 1e-6 THEN 'ALERTA' ELSE 'OK' END AS "Alerta_desviacion_std"
        FROM billed b
        JOIN (SELECT "CodigoGenerico", MAX("Cantidad") AS maximo, MIN("Cantidad") AS minimo, AVG("Cantidad") AS media,
                     COALESCE(stddev_samp("Cantidad"), 0) AS sd
              FROM billed GROUP BY "CodigoGenerico") s ON b."CodigoGenerico" = s."CodigoGenerico"
        JOIN (SELECT "CodigoGenerico", "Cantidad" AS moda, row_number() OVER (
                         PARTITION BY "CodigoGenerico" ORDER BY COUNT(*) DESC, "Cantidad") AS rn
              FROM billed GROUP BY "CodigoGenerico", "Cantidad") m
            ON b."CodigoGenerico" = m."CodigoGenerico" AND rn = 1
        WHERE abs("Cantidad" - moda) > 1e-6""",
    "class_totals": """SELECT * REPLACE (CAST("signo" AS BIGINT) AS "signo"), "Municipio" || '-' || "Servicio" AS "Centro Costo" FROM class_totals""",
    "report_medicines": _net_report("Medicamentos", ["internal", "billed"]),
    "report_devices_billed": _net_report("Dispositivos Medicos", ["billed"]),
    "report_devices_internal": _net_report("Dispositivos Medicos", ["internal"]),
    "report_supplies": _net_report("Suministros", ["internal", "billed"]),
    "profitability": """
        SELECT a AS "field_1", i AS "idadmision", f AS "nofactura", c AS "CodigoGenerico", n AS "Nombre",
               CAST(SUM(q - rq) AS BIGINT) AS "Cantidad_Consumida", CAST(SUM(v - rv) AS DOUBLE) AS "Total_Consumido",
               CAST(SUM(bq) AS BIGINT) AS "Cantidad_Facturada", CAST(SUM(bv) AS DOUBLE) AS "Total_Facturado",
               CAST(SUM(bq - (q - rq)) AS BIGINT) AS "Diferencia_Cantidad_Total",
               CAST(SUM(bv - (v - rv)) AS DOUBLE) AS "Diferencia_Total_Total"
        FROM (SELECT CAST(COALESCE(g."field_1", 0) AS BIGINT) AS a, COALESCE(g."idadmision", 0) AS i, g."nofactura" AS f,
                     COALESCE(g."CodigoGenerico", 0) AS c, g."Nombre" AS n, COALESCE(g.q, 0) AS q, COALESCE(g.v, 0) AS v,
                     COALESCE(g.bq, 0) AS bq, COALESCE(g.bv, 0) AS bv,
                     COALESCE(r."Cantidad", 0) AS rq, COALESCE(r."ValorTotal", 0) AS rv
              FROM (SELECT "field_1", "Clasificacion_consumo", "ADM-CodGen", "idadmision", "nofactura", "CodigoGenerico",
                           "Nombre", SUM("Cantidad") AS q, SUM("ValorTotal") AS v, SUM("billed_qty") AS bq,
                           SUM("billed_value") AS bv
                    FROM with_billing GROUP BY ALL) g
              FULL JOIN (SELECT "ADM-CodGen", "Cantidad", "ValorTotal" FROM returns) r ON g."ADM-CodGen" = r."ADM-CodGen")
        GROUP BY ALL""",
    "reconciliation": f"""
        SELECT CAST(o AS DOUBLE) AS "total_consumos", CAST(i AS DOUBLE) AS "total_entradas",
               CAST(o - i AS DOUBLE) AS "total_limpio", CAST(p AS DOUBLE) AS "total_procesado",
               CAST(o - i - p AS DOUBLE) AS "diferencia", abs(o - i - p) <= 1000.01 AS "conciliacion_exitosa"
        FROM (SELECT {_raw_total([vocab.DISPENSED, *vocab.INTERNAL_OUT])} AS o,
                     {_raw_total([vocab.RETURNED, *vocab.INTERNAL_IN])} AS i,
                     (SELECT CAST(SUM("signo" * "ValorTotal") AS BIGINT) FROM class_totals) AS p)""",
}

# --- finance ---------------------------------------------------------------------------------

_GAP_FIGURES = """CAST(bv AS DOUBLE) AS "Facturado_Valor", bq AS "Facturado_Cantidad", bp AS "Precio_Facturado_Prom",
    "Especialidad", "Servicio_Corregido", "Municipio", "MedicoRealiza", "No_Factura",
    CAST(v AS DOUBLE) AS "Consumido_Valor", q AS "Consumido_Cantidad", p AS "Costo_Unitario_Prom",
    CAST(bv - v AS DOUBLE) AS "Margen_Bruto", bq - q AS "Diferencia_Cantidad", share AS "Ratio_Fact_Consumo",
    pct AS "Margen_Porcentual", bp - p AS "Spread_Precio_Costo", state AS "Estado_Facturacion", spread AS "Alerta_Spread" """

_FINANCE = {
    "supplier_price_variance": """
        SELECT "CodigoGenerico", "Nombre", "Proveedor", "Municipio", "Servicio", round(med, 6) AS "Costo_Mediano",
               round(pa, 6) AS "Costo_Promedio", round(sd, 6) AS "Desv_Estandar", lo AS "Costo_Minimo", hi AS "Costo_Maximo",
               vol AS "Volumen_Total", val AS "Valor_Total_Comprado", nt AS "Num_Transacciones",
               round(sd / med, 6) AS "CV_Costo", round((hi - lo) / med, 6) AS "Rango_Porcentual",
               round(hi - lo, 6) AS "Diferencia_Absoluta", round(pa, 6) AS "Precio_Promedio_Proveedor",
               round(market, 6) AS "Mediana_Mercado", round((pa - market) / market, 6) + 0 AS "Desviacion_Vs_Mercado_Pct",
               round(pa - market, 6) + 0 AS "Desviacion_Vs_Mercado_Abs",
               CASE WHEN sd / med > 0.3 THEN 'ALTO_RIESGO' WHEN sd / med > 0.15 THEN 'MEDIO_RIESGO' ELSE 'NORMAL' END
                   AS "Nivel_Riesgo_Variabilidad",
               CASE WHEN abs((pa - market) / market) > 0.25 THEN 'PRECIO_ANOMALO'
                    WHEN abs((pa - market) / market) > 0.10 THEN 'PRECIO_ALERTA' ELSE 'PRECIO_NORMAL' END
                   AS "Alerta_Precio_Mercado",
               CASE WHEN vol < 10 THEN 'BAJO_VOLUMEN' WHEN vol < 100 THEN 'VOLUMEN_MEDIO' ELSE 'ALTO_VOLUMEN' END
                   AS "Clasificacion_Volumen"
        FROM (SELECT *, median(med) OVER (PARTITION BY "CodigoGenerico", "Nombre") AS market
              FROM (SELECT "CodigoGenerico", "Nombre", "Proveedor", "Municipio", "Servicio",
                           median(CAST("ValorUnitario" AS DOUBLE)) AS med,
                           CAST(SUM("ValorUnitario") AS DOUBLE) / COUNT("ValorUnitario") AS pa,
                           stddev_samp(CAST("ValorUnitario" AS DOUBLE)) AS sd,
                           CAST(MIN("ValorUnitario") AS DOUBLE) AS lo, CAST(MAX("ValorUnitario") AS DOUBLE) AS hi,
                           CAST(SUM("Cantidad") AS BIGINT) AS vol, CAST(SUM("ValorTotal") AS DOUBLE) AS val,
                           COUNT(DISTINCT "Comprobante") AS nt
                    FROM lines_out WHERE "Proveedor" <> '' AND "ValorUnitario" > 0 GROUP BY ALL))""",
    "stock_efficiency_detail": """
        SELECT * EXCLUDE (dv, dead), CAST(dv AS DOUBLE) AS "Diferencia_Valor", CAST(dead AS DOUBLE) AS "Valor_Stock_Muerto"
        FROM stock""",
    "stock_efficiency_summary": """
        SELECT t.*, st AS "Estado_Predominante",
               CASE WHEN "Total_Compras_Valor" > 0 THEN "Total_Consumo_Valor" / "Total_Compras_Valor" END AS "Ratio_Eficiencia_Global",
               CASE WHEN "Total_Compras_Valor" <> 0 THEN "Total_Stock_Muerto_Valor" / "Total_Compras_Valor" * 100 END
                   AS "Pct_Stock_Muerto_Sobre_Compras"
        FROM (SELECT "Municipio", "Servicio", "Clasificacion_consumo",
                     CAST(SUM(CAST("Consumo_Valor" AS DECIMAL(18,2))) AS DOUBLE) AS "Total_Consumo_Valor",
                     CAST(SUM(CAST("Entradas_Valor" AS DECIMAL(18,2))) AS DOUBLE) AS "Total_Compras_Valor",
                     CAST(SUM("Consumo_Cantidad") AS BIGINT) AS "Total_Consumo_Cantidad",
                     CAST(SUM("Entradas_Cantidad") AS BIGINT) AS "Total_Compras_Cantidad",
                     CAST(SUM(dead) AS DOUBLE) AS "Total_Stock_Muerto_Valor",
                     CAST(SUM(dv) AS DOUBLE) AS "Diferencia_Neta_Valor",
                     CAST(SUM("Diferencia_Cantidad") AS BIGINT) AS "Diferencia_Neta_Cantidad",
                     COUNT(*) FILTER (WHERE "Alerta_Costo_Unitario" <> 'NORMAL') AS "Productos_Con_Alerta_Costo",
                     COUNT(DISTINCT "CodigoGenerico") AS "Num_Productos_Unicos"
              FROM stock GROUP BY ALL) t
        JOIN (SELECT "Municipio" AS m, "Servicio" AS s, "Clasificacion_consumo" AS k, "Estado_Inventario" AS st,
                     row_number() OVER (PARTITION BY "Municipio", "Servicio", "Clasificacion_consumo"
                                        ORDER BY COUNT(*) DESC, "Estado_Inventario") AS rn
              FROM stock GROUP BY "Municipio", "Servicio", "Clasificacion_consumo", "Estado_Inventario") x
        ON t."Municipio" IS NOT DISTINCT FROM m AND t."Servicio" IS NOT DISTINCT FROM s
           AND t."Clasificacion_consumo" IS NOT DISTINCT FROM k AND rn = 1""",
    "billing_gap_detail": f"""
        SELECT COALESCE(fa, 0) AS "idadmision", COALESCE(fc, 0) AS "CodigoGenerico", fn AS "Nombre",
               COALESCE(ca, 0) AS "idadmision_right", COALESCE(cc, 0) AS "CodigoGenerico_right", cn AS "Nombre_right",
               {_GAP_FIGURES} FROM gap""",
    "billing_gap_detail_coalesced": f"""
        SELECT COALESCE(fa, ca, 0) AS "idadmision", COALESCE(fc, cc, 0) AS "CodigoGenerico", COALESCE(fn, cn) AS "Nombre",
               {_GAP_FIGURES} FROM gap""",
    "billing_gap_summary": """
        SELECT *, CASE WHEN "Ratio_Global" < 0.8 THEN 'SUB_FACTURACION_SERVICIO'
                       WHEN "Ratio_Global" > 1.3 THEN 'SOBRE_FACTURACION_SERVICIO'
                       ELSE 'EQUILIBRADO_SERVICIO' END AS "Alerta_Servicio"
        FROM (SELECT "Municipio", "Servicio_Corregido", "Especialidad", CAST(SUM(bv) AS DOUBLE) AS "Total_Facturado",
                     CAST(SUM(v) AS DOUBLE) AS "Total_Consumido", CAST(SUM(bv - v) AS DOUBLE) AS "Margen_Total",
                     round(median(share), 6) AS "Ratio_Mediano", round(median(pct), 6) AS "Margen_Mediano_Pct",
                     COUNT(DISTINCT COALESCE(fa, 0)) AS "Pacientes_Atendidos",
                     COUNT(DISTINCT "No_Factura") + MAX(CASE WHEN "No_Factura" IS NULL THEN 1 ELSE 0 END) AS "Facturas_Unicas",
                     COUNT(*) FILTER (WHERE state IN ('SUB_FACTURACION_CRITICA', 'SUB_FACTURACION', 'SOBRE_FACTURACION',
                                                      'SOBRE_FACTURACION_CRITICA')) AS "Registros_Con_Alerta",
                     COUNT(*) FILTER (WHERE state = 'SIN_FACTURAR') AS "Productos_Sin_Facturar",
                     COUNT(*) FILTER (WHERE spread = 'SPREAD_ANOMALO') AS "Spreads_Anomalos",
                     CASE WHEN SUM(v) > 0 THEN CAST(SUM(bv) AS DOUBLE) / CAST(SUM(v) AS DOUBLE) END AS "Ratio_Global"
              FROM gap GROUP BY "Municipio", "Servicio_Corregido", "Especialidad")""",
    "critical_alerts": """
        SELECT COALESCE(fa, 0) AS "idadmision", "Municipio", "Servicio_Corregido", "Especialidad", "MedicoRealiza",
               CAST(SUM(bv - v) AS DOUBLE) AS "Margen_Perdido_Total", CAST(SUM(bv) AS DOUBLE) AS "Facturado_Paciente",
               CAST(SUM(v) AS DOUBLE) AS "Consumido_Paciente", COUNT(DISTINCT COALESCE(fc, 0)) AS "Productos_Afectados",
               MIN("No_Factura") AS "Factura_Principal"
        FROM gap WHERE state IN ('SUB_FACTURACION_CRITICA', 'SIN_FACTURAR')
        GROUP BY COALESCE(fa, 0), "Municipio", "Servicio_Corregido", "Especialidad", "MedicoRealiza" """,
    "purchase_sale_detail": """
        SELECT "CodigoGenerico", "Nombre", "Municipio", "Servicio", round(pp, 6) AS "Precio_Compra_Prom",
               round(pm, 6) AS "Precio_Compra_Mediana", pmin AS "Precio_Compra_Min", pmax AS "Precio_Compra_Max",
               bq AS "Compras_Cantidad", CAST(bv AS DOUBLE) AS "Compras_Valor", ns AS "Num_Proveedores",
               prov AS "Proveedor_Principal", round(sp, 6) AS "Precio_Venta_Prom", round(sm, 6) AS "Precio_Venta_Mediana",
               CAST(sv AS DOUBLE) AS "Facturacion_Valor", sq AS "Facturacion_Cantidad", round(cp, 6) AS "Costo_Consumo_Prom",
               cq AS "Consumo_Cantidad", CAST(cv AS DOUBLE) AS "Consumo_Valor", round(sp - pp, 6) + 0 AS "Margen_Unitario_Prom",
               round(sm - pm, 6) + 0 AS "Margen_Unitario_Mediana", round(pct, 6) + 0 AS "Margen_Porcentual_Prom",
               CAST(sv - bv AS DOUBLE) AS "Margen_Total",
               round(CASE WHEN bv > 0 THEN CAST(sv - bv AS DOUBLE) / CAST(bv AS DOUBLE) * 100 END, 6) AS "Margen_Total_Pct",
               bq - sq AS "Diff_Cant_Compra_Venta", bq - cq AS "Diff_Cant_Compra_Consumo",
               used_share AS "Ratio_Consumo_Compra", sold_share AS "Ratio_Venta_Compra",
               round(pp - cp, 6) + 0 AS "Spread_Compra_Consumo", a_margin AS "Alerta_Margen",
               a_buy AS "Alerta_Eficiencia_Compra", a_turn AS "Alerta_Rotacion_Venta",
               round(dead, 6) AS "Valor_Stock_Muerto_Estimado"
        FROM margins""",
    "purchase_summary": """
        SELECT "Municipio", "Servicio", CAST(SUM(bv) AS DOUBLE) AS "Total_Compras",
               CAST(SUM(sv) AS DOUBLE) AS "Total_Facturacion", CAST(SUM(cv) AS DOUBLE) AS "Total_Consumo",
               CAST(SUM(sv - bv) AS DOUBLE) AS "Margen_Total_Servicio", round(SUM(dead), 6) AS "Total_Stock_Muerto",
               round(median(pct), 6) AS "Margen_Mediano_Pct", round(median(used_share), 6) AS "Eficiencia_Mediana",
               COUNT(*) FILTER (WHERE a_margin IN ('PERDIDA', 'MARGEN_BAJO')) AS "Productos_Margen_Bajo",
               COUNT(*) FILTER (WHERE a_buy IN ('SOBRE_COMPRA_CRITICA', 'SOBRE_COMPRA')) AS "Productos_Sobre_Compra",
               COUNT(DISTINCT "CodigoGenerico") AS "Num_Productos",
               CASE WHEN SUM(bv) > 0 THEN CAST(SUM(sv) AS DOUBLE) / CAST(SUM(bv) AS DOUBLE) END AS "Ratio_Venta_Compra_Servicio",
               CASE WHEN SUM(bv) > 0 THEN CAST(SUM(cv) AS DOUBLE) / CAST(SUM(bv) AS DOUBLE) END AS "Ratio_Consumo_Compra_Servicio"
        FROM margins GROUP BY "Municipio", "Servicio" """,
    "top_dead_stock": """
        SELECT "CodigoGenerico", "Nombre", "Municipio", "Servicio", prov AS "Proveedor_Principal",
               round(pp, 6) AS "Precio_Compra_Prom", round(sp, 6) AS "Precio_Venta_Prom",
               round(sp - pp, 6) + 0 AS "Margen_Unitario_Prom", round(pct, 6) + 0 AS "Margen_Porcentual_Prom",
               bq AS "Compras_Cantidad", cq AS "Consumo_Cantidad", bq - cq AS "Diff_Cant_Compra_Consumo",
               round(dead, 6) AS "Valor_Stock_Muerto_Estimado", a_buy AS "Alerta_Eficiencia_Compra", a_margin AS "Alerta_Margen"
        FROM margins WHERE dead > 0
        ORDER BY dead DESC, "CodigoGenerico", "Nombre", "Municipio", "Servicio" LIMIT 50""",
}


def _rounded(name: str, columns: tuple[str, ...]) -> str:
    """A query over the composed inputs, whose unit prices are means of means in double."""
    cells = ", ".join(f'round("{c}", 6) + 0 AS "{c}"' for c in columns)
    return _sql(f"SELECT * REPLACE ({cells}) FROM ({_FINANCE[name]})", COMPOSED)


def _financial_report() -> dict[str, str]:
    return {
        "financial_report_stock_summary": _sql(_FINANCE["stock_efficiency_summary"], COMPOSED),
        "financial_report_gap": _rounded(
            "billing_gap_detail", ("Precio_Facturado_Prom", "Costo_Unitario_Prom", "Spread_Precio_Costo")
        ),
        "financial_report_gap_summary": _sql(_FINANCE["billing_gap_summary"], COMPOSED),
        "financial_report_alerts": _sql(_FINANCE["critical_alerts"], COMPOSED),
    }


_OTHER = {
    "period_normalised": """
        SELECT strftime(o_orderdate, '%d/%m/%Y') AS "periodo", strftime(o_orderdate, '%m') AS "mes", COUNT(*) AS n
        FROM orders GROUP BY ALL""",
    "source_lineage": """
        SELECT 'lineitem.parquet' AS "ArchivoOrigen", COUNT(*) AS "registros" FROM lineitem
        UNION ALL SELECT 'orders.parquet', COUNT(*) FROM orders
        UNION ALL SELECT 'part.parquet', COUNT(*) FROM part""",
    "ledger_from_files": """
        SELECT CASE WHEN o_orderstatus = 'P' THEN 'ANULADO' ELSE 'CONFIRMADO' END AS "Estado",
               CASE WHEN l_partkey % 3 = 1 THEN lpad(CAST(l_partkey AS VARCHAR), 8, '0')
                    ELSE CAST(l_partkey AS VARCHAR) END AS "CodigoGenerico",
               CASE WHEN l_partkey % 3 <> 2 THEN p_type END AS "GrupoInventario", COUNT(*) AS "registros",
               CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS "Cantidad",
               CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS "ValorTotal"
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
             JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
        GROUP BY ALL""",
    "billing_rejects": """
        SELECT '(line)' AS "column", NULL AS "text", 'line of another width' AS "reason", COUNT(*) AS n
        FROM bill_text WHERE wide HAVING COUNT(*) > 0
        UNION ALL SELECT 'cantidad', 'x' || CAST(q AS VARCHAR), 'no bigint', COUNT(*) FROM bill_text WHERE no_qty AND NOT wide GROUP BY q
        UNION ALL SELECT 'vrtotal', '1.234.50', 'no double', COUNT(*) FROM bill_text WHERE no_value AND NOT wide HAVING COUNT(*) > 0
        UNION ALL SELECT '(accepted)', CAST(CAST(SUM(q) AS BIGINT) AS VARCHAR), NULL, COUNT(*)
        FROM bill_text WHERE NOT (wide OR no_qty OR no_value)""",
}


def all_sql() -> dict[str, str]:
    plain = {name: _sql(body) for name, body in {**_LEDGER, **_CONSUMPTION, **_FINANCE, **_OTHER}.items()}
    return {
        **plain,
        **_financial_report(),
        "monthly_purchase_behaviour": _monthly_purchases(),
        "lent_balance": _loan("lent", "SaldoPrestamos_realizados", "Saldo_Prestamos_Realizados"),
        "borrowed_balance": _loan("borrowed", "SaldoPrestamos_recibidos", "Saldo_Prestamos_Recibidos"),
        "movement_by_product": _movement(P3, [f for f in vocab.FAMILIES if f != "transfers"]),
        "movement_by_warehouse_product": _movement(f'"Bodega", {P3}', vocab.FAMILIES),
        "monthly_qty": _monthly("q", "BIGINT", "Total_Cantidad", "Mensual"),
        "monthly_value": _monthly("v", "DOUBLE", "Total_Valor", "Valor"),
        **{f"net_by_voucher_{f}": _net_family(f) for f in vocab.FAMILIES},
    }

"""Schemas of the input entities and the names the billing columns take at ingest.

Column names and lists are fixed values: they must equal those of the input files and reports.
"""

LEDGER_DDL = (
    "Fecha string, TipoMovimiento string, Comprobante string, Estado string, Bodega string, "
    "CodigoGenerico string, GrupoInventario string, Generico string, Tercero string, "
    "Cantidad bigint, Costo double, ValorBruto double, ValorTotal double, ValorIva double, "
    "ValorDescuento double"
)
# Measures in which an unreadable value counts as missing.
LEDGER_LENIENT = ("Cantidad", "ValorTotal")
# What the inventory reports cannot do without.
LEDGER_NEEDED = [
    "Fecha", "TipoMovimiento", "Comprobante", "Estado", "Bodega", "CodigoGenerico", "GrupoInventario", "Generico",
    "Tercero", "Cantidad", "ValorTotal",
]
EXTRACT_DDL = (
    "Comprobante string, Numero bigint, Fecha string, NoDocumento string, Proveedor string, "
    "CentroCosto string, Dependencia string, Bodega string, CodGrupo string, Grupo string, "
    "CodArticulo string, Articulo string, Cantidad bigint, ValorUnitario double, TotalBruto double, "
    "ValorIVA double, ValorDescuento double, ValorTotal double, Unidad string, "
    "LaboratorioMarca string, Observacion string, Usuario string, User string, FechaDigitacion string"
)
BILLING_DDL = (
    "idadmision bigint, nofactura string, idusuario string, nomtiposervicio string, codigo string, "
    "nombre string, cantidad bigint, CantidadSolicitada bigint, vrunitario double, vrtotal double, "
    "Especialidad string, MedicoRealiza string"
)
LISTING_DDL = "Codigo string, Nombre string, CodigoGenerico string, EstadoArticulo string"
ENTITIES_DDL = "entidad string"

# What the consumption reports cannot do without, by extract.
MOVEMENT_NEEDED = [
    "Comprobante", "Fecha", "NoDocumento", "Proveedor", "CentroCosto", "Dependencia", "Bodega", "CodGrupo", "Grupo",
    "CodArticulo", "Cantidad", "ValorUnitario", "TotalBruto", "ValorIVA", "ValorDescuento", "ValorTotal", "Unidad",
    "User", "FechaDigitacion",
]
NEEDED_OF_EXTRACTS = {
    "billing": [field.split()[0] for field in BILLING_DDL.split(", ")],
    "out": MOVEMENT_NEEDED,
    "in": MOVEMENT_NEEDED,
    "listing": [field.split()[0] for field in LISTING_DDL.split(", ")],
}

# The billing report tells `cantidad` and `nombre` from the ledger's `Cantidad` and
# `Nombre` by case alone, which Spark does not; they get names of their own on reading.
BILLING_NAMES = {
    "nombre": "billed_name",
    "cantidad": "billed_qty",
    "CantidadSolicitada": "requested_qty",
    "vrunitario": "billed_unit_price",
    "vrtotal": "billed_value",
}

# The grain both kinds of billed movement are grouped to.
GRAIN = [
    "Comprobante", "Fecha", "NoDocumento", "Proveedor", "CentroCosto", "Dependencia", "Bodega",
    "Unidad", "User", "FechaDigitacion", "field_1", "Clasificacion_consumo", "Municipio", "Servicio",
    "Tipo_servicio", "Nombre", "CodGrupo", "Grupo", "CodigoGenerico", "EstadoArticulo",
]
BILLING_GRAIN = [
    "idadmision", "nofactura", "idusuario", "nomtiposervicio", "codigo", "billed_name",
    "Especialidad", "MedicoRealiza",
]
UNCLOSED_COLUMNS = [
    "Comprobante", "Fecha", "CentroCosto", "Dependencia", "Bodega", "CodGrupo", "Grupo", "codigo",
    "Nombre", "Cantidad", "ValorUnitario", "TotalBruto", "ValorIVA", "ValorDescuento", "ValorTotal",
    "ADM-CodGen", "idadmision", "nofactura", "idusuario", "nomtiposervicio", "Servicio",
]
DEVIATION_COLUMNS = [
    "Comprobante", "Fecha", "NoDocumento", "CentroCosto", "Dependencia", "Bodega", "CodGrupo", "Grupo",
    "CodigoGenerico", "Nombre", "Cantidad", "ValorTotal", "Cantidad_moda", "Cantidad_maximo",
    "Cantidad_media", "Cantidad_std", "Cantidad_minimo", "Desviacion_moda", "Desviacion_media",
    "Desviacion_std", "Desviacion_maximo", "Desviacion_minimo", "Alerta_desviacion_moda",
    "Alerta_desviacion_media", "Alerta_desviacion_std",
]

"""Explicit schemas of the gazette's entities; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


#: The three lists of a day's index in publication order, with their edition codes
EDITIONS = [("NotasMatutinas", "MAT"), ("NotasVespertinas", "VES"), ("NotasExtraordinarias", "EXT")]

_S, _L, _I, _D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()

NOTE_ENTRY = _struct(
    codNota=_L, titulo=_S, fecha=_S, codOrgaUno=_S, nombreCodOrgaUno=_S, codSeccion=_S, pagina=_I, codDiario=_L, orden=_D,
    existeHtml=_S, existeDoc=_S, existeImagen=_S, existePdf=_S,
)
DAY_INDEX = _struct(messageCode=_I, response=_S, **{name: T.ArrayType(NOTE_ENTRY) for name, _ in EDITIONS})
NOTE_DETAIL = _struct(Nota=_struct(codNota=_L, titulo=_S, codEdicion=_S, fecha=_S, codDiario=_L, pagina=_I, cadenaContenido=_S))
IMAGE_LISTING = _struct(imagenesFS=T.ArrayType(_struct(codImagen=_L, pagina=_I, nombreArchivo=_S)))
TITLE_RECORD = _struct(codNota=_L, titulo=_S, fecha=_S, codOrgaUno=_S)
RELEASE = _struct(assets=T.ArrayType(_struct(name=_S, browser_download_url=_S, size=_L)))
BOUNDARY = "start int, start_confidence double, start_longest int, end int, end_confidence double, end_longest int"

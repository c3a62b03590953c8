"""The record types that flow between stages, and the rows that are delivered."""

from __future__ import annotations

#: What every feed, page and JSON source yields: one row a document, ``pos`` its place within the source.
RAW = "fonte_id int, pos long, titolo string, url string, testo string, immagine string, data timestamp, luogo string"
NEWS = "titolo string, estratto string, immagine string, url string, data string, fonte_id int, dedup_key string"
EVENT = "titolo string, data_inizio string, luogo string, descrizione string, immagine string, url string, fonte_id int, dedup_key string"
INSTITUTIONAL = "fonte_id int, titolo string, url string, tipo_atto string, data string, contenuto string, dedup_key string"
ACT = (
    "dedup_key string, url string, tipo string, numero int, anno int, data string, titolo string, chiave string, cita array<string>, "
    "coordinato boolean, categoria string, aggiornato_al string, caratteri long"
)
PASSAGES = "array<struct<ordine:int,etichetta:string,testo:string>>"
OUTCOME = "fonte_id int, tipo string, esito string, documenti long, n_righe long, nuove long, errore string"
SELECTORS = "item string, titolo string, link string, data string, luogo string, immagine string, testo string"
DETAIL = "contenitore string, etichetta string, max int"
SOURCE = (
    "id int, nome string, config struct<url:string,tipo:string,formato:string,selettori:string,dettaglio:string,base:string,"
    "giorni_avanti:int,ore_utc:array<int>>"
)
RAW_COLUMNS = [c.split()[0] for c in RAW.split(", ")]

"""Schemas of the entities, in DDL. Reads always name one: an empty JSON array has no columns to infer."""

from __future__ import annotations

DIRECTORY = "kraj string, url string, okresy array<struct<nazov:string,url:string>>"
_DOCUMENT = "datum:string,nazov:string,url:string"
_BOARD = "kraj string, url string, okresy array<struct<nazov:string,url:string,url_tabule:string,error:string,dokumenty_zivotne_prostredie:array<struct<kategoria:string,dokumenty:array<struct<{}>>>>>>"
BOARD = _BOARD.format(_DOCUMENT)
ANALYSED_BOARD = (_BOARD.format(_DOCUMENT + ",doc_id:string,analyza:string,error:string"))
LISTING = "nazov string, url string, datum string, popis string"
PROCESSED = "nazov string, url string, datum string, popis string, kraj string, okres string, doc_id string, error string"
ANALYSIS = ("cislo_konania_spisu string, cislo_rozhodnutia string, datum_dokumentu string, datum_zverejnenia string, lehoty_na_vyjadrenie string, "
    "ziadatel_navrhovatel string, miesto_realizacie struct<kraj:string,okres:string,obec:string,nazov_lokality:string,"
    "katastralne_uzemia:array<struct<nazov:string,parcely:array<struct<typ:string,cisla:array<string>>>>>>, typ_dokumentu string, "
    "typ_zasahu array<string>, typ_uzemia array<string>, druh_chraneneho_uzemia array<string>, nazov_konania_dokumentu string, "
    "je_v_chranenom_uzemi boolean, dotknute_zivocichy_rastliny array<string>, odkaz_enviroportal string, "
    "paragrafy array<struct<paragraf:string,odsek:string,pismena:array<string>,zakon_nazov:string,zakon_cislo:string>>, zhrnutie string"
)
STATUS = "source string, kraj string, okres string, doc_id string, run_id long, date string, type string, text string"
STORED = "source string, kraj string, okres string, doc_id string, file_name string, content string"
PAGE = "url string, http_status int, content_type string, body binary, error string"

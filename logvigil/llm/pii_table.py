"""The small labelled table of the personal-data model: a span is written [kind text]."""

LABELLED_LINES = """
Please write to [email jane.doe@example.com] before noon.
Her address is [email k.lund@mail.example.org], not the old one.
Contact: [email office@city-hall.example.net]; bring a photo.
Send it to [email sam at example dot com] or drop by.
You may reach me via [email lee (at) example (dot) org] this week.
Mail [email ana_88@example.co.uk] and [email bob.k@example.de] about it.
Ask for [email maria [at] example [dot] net] in the office.
Schreiben Sie an [email h.braun@post.example.de] bis Freitag.
Écrivez à [email luc.martin@courrier.example.fr] avant midi.
Escriba a [email rosa.gil@correo.example.es] por favor.
and then [email hfk.52@mail4.example.com] of the
écrire [email tbmo.07@mail2.example.com] en ce lieu
der [email rsk.88@post1.example.org]. Und dann
ofthe [email dcph.43@mail3.example.com] ingbreth to
por la [email abcde.19@mail9.example.com], osue.
ción ción ción ción ción ción ción ción
été été été été été été
à la coga coga ción ción ción
call [phone +1 (207) 555-2084] and pay [card 4223467183776529] now
+1 is one more
the server [ip 10.20.30.40] was down and [ip 192.168.7.21] took over.
Login from [ip 81.52.46.243] at night.
Ping [ip 172.16.254.1], then restart the host.
Der Rechner [ip 66.87.218.26] antwortet nicht.
la machine [ip 93.190.138.19] ne répond pas
traffic of [ip 8.8.4.4] and [ip 1.1.1.1] was high
Call [phone +1 (807) 555-6237] after six.
My number is [phone +44 20 7946 0958], she said.
Phone [phone (212) 555-0187] or [phone 415-555-0132] for help.
Tel. [phone 030 901820] oder [phone +49 30 901821] anrufen.
tel: [phone 01 70 18 99 00] le matin
Llame al [phone +34 912 345 678] mañana.
fax [phone 555-0143] and phone [phone 555-0199] are new
ring me on [phone 0161 496 0345] tonight
[phone +1 (477) 555-4197] is the number of the shop
Pay with card [card 4270558249789290] today.
card number [card 4111 1111 1111 1111] was charged
Visa [card 5500-0000-0000-0004] expires in May.
Karte [card 4539 5787 6362 1486] wurde gesperrt
la carte [card 6011000990139424] est valide
the account was charged on [card 4716-2210-5188-5662] twice
She met him at noon and they spoke about the weather.
He was born in 1984 and moved in 2003.
Version 2.0.1 of the tool came out on 2021-05-06.
Chapter 3.4.2.1 explains why 12 of 15 tests failed.
The price is $1,299.99 or 1.099,00 EUR.
Room 214, floor 3, at 10:30 am on 05/11/2019.
Order 20210506-17 has 240 parts of 35 mm.
call me when you get home , they said
card games and phone booths were fun in 1990
The mail came late and the address was wrong.
password=9f84c612aa5cba46ca and token = "db8893c698e1f506d883a7dd2f8050f1360e69f6"
api_key: 77c0ffee12ab34cd56ef78ab90 was revoked
THE!! OF!! AND!! 12!! RES!! BIG!!
ered*** reed*** of%%% to%%% and&&& in### est$$$
name | place | year | 1999 | 2001 | sum
Der Zug kommt um 7 Uhr an und fährt 120 km.
Les élèves ont lu 35 pages en 2 heures.
Los niños ven 12 aves en el río, cerca de aquí.
Licensed under the Apache License, Version 2.0.
All rights reserved. Copyright 2015.
at the dot of nine he left ; at ten he came back
x = 3.14159 and y = 2.71828 , error 0.001
Population 8,336,817 in 2016, area 1213.4 km.
Section 12-4, lines 100-250, pages 7-9.
one two three four five six seven
Stund en der ist die ungkeit, schver auf das.
Mentpa Mentpa Mentpa Mentpa Mentpa
at at at at at at at at at
at, at, at, at, at, at, at, at,
dot dot dot dot dot dot
queenpa queenpa queenpa queenpa queenpa queenpa
Eau et la de ément oiré que tionelle, ç.
Ción de los asora mente, jabo ñas.
(see figure 4) the results of 2019 (n = 512)
https://www.example.org/en/742/ is the page
12:30:45 is the time and 7/8 is the share
ISBN 978-3-16-148410-0 is a book
[see note] the text says a lot (maybe too much)
""".strip()

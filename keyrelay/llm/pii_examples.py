"""Labelled sentences for the field that finds personal data: a training table, and a held-out table of other sentences with
other fillings. Marked words {kind:words} carry the label, all others are outside; %X is a slot."""

from __future__ import annotations

import re

TRAIN = """
please call {phone:%P} before noon
my phone is {phone:%Q} thanks
tel {phone:%Q} or fax {phone:%P}
reach the office at {phone:%P} any day
cell {phone:%P} and mobile {phone:%Q}
dial {phone:%P} for help
the number +1 {phone:%P} rings
phone {phone:%T}
phone: {phone:%T} (home)
my mobile is {phone:%T} now
call {phone:%G} after six
telephone {phone:%G} or write
you can ring {phone:%G} at home
text me on {phone:%T} please
contact {phone:%Q}
her number is {phone:%P} at work
phone number {phone:%Q}
hotline {phone:%Q} is open
los {phone:%P} und
de {phone:%Q} la
her ssn is {ssn:%S} on file
ssn {ssn:%S}
ssn: {ssn:%S} and born in %Y
social security {ssn:%S} was given
social security number {ssn:%S}
taxpayer {ssn:%S} filed late
his social is {ssn:%S} he said
holder {ssn:%S} of the account
the {ssn:%S} of
er {ssn:%S} und
write to {email:%E} today
email {email:%E} or call {phone:%P}
mail {email:%E} for details
the host {ip:%I} is down
server {ip:%I} answered
ping {ip:%I} first
address {ip:%I}
the {ip:%I} of the
card {card:%C} was charged
paid by visa {card:%C} yesterday
credit card number {card:%C}
number {card:%C} is valid
the {card:%C} of
de {card:%C} le
phone no. {phone:%Q} is new
phone no {phone:%T}
ssn no. {ssn:%S} was checked
social security no. {ssn:%S} on the form
social insurance no {ssn:%S}
my social is {ssn:%S}
mobile {phone:%G}
mobile number {phone:%G} is off
landline {phone:%G} rings
cell {phone:%T}
version %S
version %S fixes it
the version %Q came late
score %S
score %Q
a score of %Q
final score %Q after extra time
host {ip:%I} runs
node {ip:%I} is up
los {phone:%W} {card:%C} {ip:%I}
phone {phone:%W} and card {card:%C}
call {phone:%W} now
version %V was released in %Y
version %B ships today
version %S is out
part no. %S is out of stock
part no. %Q in the box
part number %B in stock
part %S costs %N euros
item no. %T in the list
serial no. %T was made in %Y
serial number %B on the back
order %L shipped on %D
order no. %T has left
order number %Q was shipped
order %S was sent
order no. %S waits
lot no. %S of the sale
invoice %S is due
invoice no. %Q of %D
reference %S in the file
reference %T of the letter
ref. %Q is closed
isbn %B was printed
catalogue no. %Q on page %N
model %S with %N parts
case no. %S was heard
tracking %T arrived
ticket %T was closed on %D
chapter %N of the book has %N pages
about %N people came in %Y and %N left
price %N dollars or %V euros
meet at noon at the dot of %N
the code %L has no owner
code %T opens nothing
look at the dot com boom of %Y
on %D the score was %H at the end
score %Q in the game
the final score was %B in %Y
call the shop at noon
he paid by card in the shop
in %Y we counted %N of %N items
line %L has %H and %V
room 555 seats %N people
section %V of %N lists %L
token %X expires on %D
size %N by %N by %N
from %Y to %Y there were %N cases
population %M in %Y
distance %M km in %N days
grid %B on the map
the sum %L was paid on %D
licensed under CC BY %Z
licensed under CC BY-NC %Z
under the license, version %Z
released under CC BY-SA %Z today
the %Z of the
%Z
the %K of
er %K und
la %K la
of %K !!
%K
%N %N %N %N
%D %H
id %L of %N
%X %X
"""

HELD_OUT = """
give us a ring on {phone:%P} this week
you may call me at {phone:%Q} tomorrow
phone {phone:%T} for a quote
Call {phone:%G}
mobile {phone:%G} only in an emergency
fax: {phone:%Q}
the clinic, tel {phone:%P} , is closed
she gave her phone as {phone:%T} again
his ssn was {ssn:%S} then
social security no {ssn:%S} is known
employee ssn: {ssn:%S}
send it to {email:%E} by friday
questions go to {email:%E} first
the server at {ip:%I} failed twice
log in to host {ip:%I} as root
visa {card:%C} was declined
his credit card {card:%C} expired
part no. %S fits all wheels
version %S of the tool
version %B was withdrawn
order no. %Q came back
invoice %T was paid on %D
serial no. %S is engraved
serial number %T below the seat
score %Q at half time
reference %Q of our letter
the isbn is %B here
item no. %Q in blue
in %Y some %N of %N voted
chapter %N ends on page %N
ticket %S was lost
on %D it was %H after all
we sold %M units in %Y
case no. %T is pending
section %V lists %N ways
"""

#: Fillings of the slots; those of the held-out table share no text with the others.
FILL = {"P": ["(523) 555-1055", "(771) 555-1655", "523 555-1055"], "Q": ["523-555-1055", "771.555.1655", "305-555-0142"],
        "T": ["5235551055", "7715551655", "02079460000"], "G": ["020 7946 0018", "0151 496 0733", "07700 900 461"],
        "W": ["555-9331", "555-0102", "555.0167"], "S": ["123-45-6789", "219-09-9999", "457-55-5462"],
        "E": ["ann.lee@example.com", "bob7@mail.example.org", "c_d@example.net"],
        "I": ["10.0.12.7", "192.168.1.254", "71.9.33.120"],
        "C": ["4111111111111111", "5500005555555559", "4012-8888-8888-1881"],
        "V": ["1.2.3", "3.11", "2.0.4.999"], "Y": ["1999", "2024", "1850"], "L": ["4111111111111112", "990012345678901234", "77120"],
        "D": ["2024-01-31", "12.05.2021", "3-4-1999"], "N": ["12", "7", "340"], "H": ["3-1", "21:14", "100-98"],
        "B": ["12-345-678", "978-3-16-148410-0", "55-1200-34"], "M": ["1,204,337", "84 000 000", "7 120"],
        "Z": ["4.0", "2.0", "3.1"], "K": ["5927243074273350", "4916000011112222", "3700111122223334"],
        "X": ["f33e61083db5dbdf", "9d0c-11aa-77fe", "a1b2c3d4e5"]}
HELD_FILL = {"P": ["(212) 555-0180", "(415) 555-0134", "646 555-0191"], "Q": ["212-555-0180", "415.555.0199", "646-555-0107"],
             "T": ["4155552671", "2125550180", "02079460958"], "G": ["020 7946 0958", "0117 496 0217", "07700 900 982"],
             "W": ["555-0148", "555-8812", "555.4410"], "S": ["987-65-4320", "078-05-1120", "331-20-4471"],
             "E": ["jo@example.edu", "x.y-z@sub.example.com", "team+1@example.io"], "I": ["172.16.4.9", "8.8.4.4", "203.0.113.77"],
             "C": ["4242424242424242", "5105105105105100", "4000-0566-5566-5556"], "V": ["4.5.6", "7.02", "10.1.0"],
             "Y": ["2011", "1987", "1776"], "L": ["6011000990139425", "123456", "880077665544332211"],
             "D": ["2023-11-05", "09.08.2019", "7-12-2003"], "N": ["45", "9", "1200"], "H": ["2-0", "08:30", "77-64"],
             "B": ["34-567-890", "978-0-30-640615-7", "41-0077-12"], "M": ["2,450,118", "91 500 000", "3 808"],
             "X": ["0be4c77a19", "77aa-0c0d-91ef", "e5d4c3b2a1"]}


def labelled(sentences: str, fill: dict[str, list[str]]) -> list[tuple[list[str], list[str]]]:
    """(words, labels) of sentences, each slot filled in its three ways."""
    out = []
    for line in filter(None, sentences.split("\n")):
        for k in range(3):
            words, labels = [], []
            for part in re.findall(r"\{[^}]*\}|\S+", line):
                kind, text = part[1:-1].split(":", 1) if part[0] == "{" else ("outside", part)
                text = re.sub(r"%([A-Z])", lambda m: fill[m[1]][k], text)
                words += text.split()
                labels += [kind] * len(text.split())
            if (words, labels) not in out:
                out.append((words, labels))
    return out


def training_table() -> list[tuple[list[str], list[str]]]:
    return labelled(TRAIN, FILL)


def held_out_table() -> list[tuple[list[str], list[str]]]:
    return labelled(HELD_OUT, HELD_FILL)

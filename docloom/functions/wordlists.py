"""Word lists. Results depend on every entry."""

from __future__ import annotations

#: Small words left out of telegraphic notes.
STOPWORDS = frozenset(
    """
    a an the of to in on at by for from with into onto upon as that which who whom whose
    this these those is are was were be been being has have had do does did will would shall
    should may might can could must it its their there here such any each than then so
    and or but if when where while because although though also only even very
    he she him her his hers they them theirs we us our you your i me my
    """.split()
)

#: Terms of art, which never count as copied wording. Entries are parted by bars.
TERMS_OF_ART = """
    res judicata | collateral estoppel | claim preclusion | issue preclusion | direct estoppel
    equitable estoppel | promissory estoppel | judicial estoppel | stare decisis | ratio decidendi
    obiter dictum | obiter dicta | final judgment on the merits | judgment on the merits
    final judgment | final order | summary judgment | default judgment | consent decree
    declaratory judgment | preliminary injunction | permanent injunction | temporary restraining order
    privity | in privity with | same cause of action | cause of action | primary right
    burden of proof | standard of proof | preponderance of the evidence | clear and convincing evidence
    beyond a reasonable doubt | prima facie case | prima facie | de novo | abuse of discretion
    substantial evidence | judicial review | writ of mandate | writ of mandamus | writ of certiorari
    quasi-judicial | administrative law judge | administrative proceeding | administrative remedies
    exhaustion of administrative remedies | full faith and credit | statute of limitations
    limitation period | laches | waiver | estoppel | mitigation of damages | punitive damages
    compensatory damages | liquidated damages | specific performance | breach of contract
    breach of duty | duty of care | standard of care | proximate cause | vicarious liability
    respondeat superior | course of employment | scope of employment | wrongful termination
    wrongful dismissal | constructive discharge | constructive dismissal | at-will employment
    retrenchment | lay-off | layoff | lock-out | unfair labour practice | unfair labor practice
    industrial dispute | collective bargaining agreement | collective bargaining | grievance procedure
    arbitration award | arbitration agreement | binding arbitration | class action | class certification
    due process | equal protection | natural justice | audi alteram partem | bona fide | mala fide
    ultra vires | locus standi | sub judice | ex parte | inter alia | mens rea | actus reus
    bodily injury | property damage | personal injury | occurrence | wrongful act | duty to defend
    duty to indemnify | coverage | exclusion | insured | insurer | policyholder | indemnity
    reasonable accommodation | disparate treatment | disparate impact | hostile work environment
    protected activity | adverse employment action | retaliation | discrimination | harassment
"""


def terms_of_art() -> list[str]:
    """The distinct terms, longest first, so that a longer term is tried before one inside it."""
    own = {" ".join(t.split()) for line in TERMS_OF_ART.splitlines() for t in line.split("|") if t.strip()}
    return sorted(own, key=lambda t: (-len(t), t))

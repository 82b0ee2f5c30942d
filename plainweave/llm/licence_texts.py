"""Real licence texts: notices and short licences as they stand in files, whole licences as
their sets of terms. AGPL-3.0 is GPL-3.0 with the terms of its own passages."""

# Texts of licences.
NOTICES = [
    (
        "GPL-2.0",
        'This program is free software; you can redistribute it and/or modify it under the terms of the GNU '
        'General Public License as published by the Free Software Foundation; either version 2 of the '
        'License, or (at your option) any later version. This program is distributed in the hope that it will '
        'be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS '
        'FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have '
        'received a copy of the GNU General Public License along with this program. If not, see '
        '<https://www.gnu.org/licenses/>. ',
    ),
    (
        "GPL-3.0",
        'This program is free software; you can redistribute it and/or modify it under the terms of the GNU '
        'General Public License as published by the Free Software Foundation; either version 3 of the '
        'License, or (at your option) any later version. This program is distributed in the hope that it will '
        'be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS '
        'FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have '
        'received a copy of the GNU General Public License along with this program. If not, see '
        '<https://www.gnu.org/licenses/>. ',
    ),
    (
        "LGPL-2.1",
        'This library is free software; you can redistribute it and/or modify it under the terms of the GNU '
        'Lesser General Public License as published by the Free Software Foundation; either version 2.1 of '
        'the License, or (at your option) any later version. This library is distributed in the hope that it '
        'will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or '
        'FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details. You '
        'should have received a copy of the GNU Lesser General Public License along with this library. If '
        'not, see <https://www.gnu.org/licenses/>. ',
    ),
    (
        "LGPL-3.0",
        'This library is free software; you can redistribute it and/or modify it under the terms of the GNU '
        'Lesser General Public License as published by the Free Software Foundation; either version 3 of the '
        'License, or (at your option) any later version. This library is distributed in the hope that it will '
        'be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS '
        'FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details. You should '
        'have received a copy of the GNU Lesser General Public License along with this library. If not, see '
        '<https://www.gnu.org/licenses/>. ',
    ),
    (
        "AGPL-3.0",
        'This program is free software; you can redistribute it and/or modify it under the terms of the GNU '
        'Affero General Public License as published by the Free Software Foundation; either version 3 of the '
        'License, or (at your option) any later version. This program is distributed in the hope that it will '
        'be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS '
        'FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details. You should '
        'have received a copy of the GNU Affero General Public License along with this program. If not, see '
        '<https://www.gnu.org/licenses/>. ',
    ),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        'compliance with the License. You may obtain a copy of the License at '
        'http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in '
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT '
        'WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific '
        'language governing permissions and limitations under the License. ',
    ),
    (
        "MPL-2.0",
        'This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of '
        'the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/. ',
    ),
    (
        "MIT",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and '
        'associated documentation files (the "Software"), to deal in the Software without restriction, '
        'including without limitation the rights to use, copy, modify, merge, publish, distribute, '
        'sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is '
        'furnished to do so, subject to the following conditions: The above copyright notice and this '
        'permission notice shall be included in all copies or substantial portions of the Software. THE '
        'SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        'LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. '
        'IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER '
        'LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN '
        'CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. ',
    ),
    (
        "BSD-2-Clause",
        'Redistribution and use in source and binary forms, with or without modification, are permitted '
        'provided that the following conditions are met: Redistributions of source code must retain the above '
        'copyright notice, this list of conditions and the following disclaimer. Redistributions in binary '
        'form must reproduce the above copyright notice, this list of conditions and the following disclaimer '
        'in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS '
        'PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
        'INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A '
        'PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE '
        'FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT '
        'NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR '
        'BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT '
        'LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS '
        'SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE. ',
    ),
    (
        "BSD-3-Clause",
        'Redistribution and use in source and binary forms, with or without modification, are permitted '
        'provided that the following conditions are met: Redistributions of source code must retain the above '
        'copyright notice, this list of conditions and the following disclaimer. Redistributions in binary '
        'form must reproduce the above copyright notice, this list of conditions and the following disclaimer '
        'in the documentation and/or other materials provided with the distribution. Neither the name of the '
        'copyright holder nor the names of its contributors may be used to endorse or promote products '
        'derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY '
        'THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT '
        'NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE '
        'DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, '
        'INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, '
        'PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS '
        'INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, '
        'OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN '
        'IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE. ',
    ),
    (
        "Unlicense",
        'This is free and unencumbered software released into the public domain. Anyone is free to copy, '
        'modify, publish, use, compile, sell, or distribute this software, either in source code form or as a '
        'compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions '
        'that recognize copyright laws, the author or authors of this software dedicate any and all copyright '
        'interest in the software to the public domain. We make this dedication for the benefit of the public '
        'at large and to the detriment of our heirs and successors. We intend this dedication to be an overt '
        'act of relinquishment in perpetuity of all present and future rights to this software under '
        'copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, '
        'INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND '
        'NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, '
        'WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE '
        'SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, please refer to '
        '<https://unlicense.org> ',
    ),
]
WHOLE = {
    "AGPL-3.0": (
        '0 1 10 11 12 13 14 15 16 17 1996 2 20 2007 28 29 3 30 4 5 6 60 6b 6d 7 8 9 a ability about above '
        'absence absolute absolutely abuse accept acceptance access accessible accompanied accompanies accord '
        'according achieve acknowledges acquired across actions activities activity actual actually adapt add '
        'added additional address addressed adopted adversely advised affects affero affirmed affirms after '
        'against aggregate agree agreed agreement aim all alleging allow allowed along already also alternate '
        'alternative although among an ancillary and anti any anyone anything applicable applications applied '
        'applies apply appropriate appropriately approximates are area arise arising arrange arrangement '
        'article as asking assert assets associated assume assumption assumptions assures at attach attempt '
        'attributed attributions author authorization authorized authorizes authorizing authors automatic '
        'automatically available avoid away b based basic be because become been behalf being believe below '
        'benefit best between beyond body both box brief business but by c called can cannot carry case cases '
        'cause cease certain cessation change changed changing characterized charge choose choosing '
        'circumstances circumvention civil claim claims class clear clearly closely code collect combination '
        'combine combined come comes commands commercial commitment common communication community '
        'compilation compilations compiler compliance comply component computer computers concerning concerns '
        'conditioned conditions connection consequence consequential consider considered consistent '
        'conspicuously constantly constitutes construed consumer contact contain containing contains content '
        'contents context continue continued contractual contradict contrast contributor control controlled '
        'convenient convey conveyance conveyed conveying conveys cooperation copies copy copying copyleft '
        'copyright copyrightable copyrighted correction corresponding cost could counterclaim countries '
        'country course court courts covenant coverage covered criterion cross cure customarily customary '
        'customer d damages danger data date days december decide declining deemed defective defending '
        'defenses defined definition definitions denied denominated deny denying deprive designated designed '
        'detail details determining develop developers development devices differ different differently '
        'direction directions directly disclaim disclaimer disclaiming discriminatory display displayed '
        'displays distinguishing distribute distributed distributing distribution do document documented does '
        'domains doubtful downstream durable dwelling dynamically e each earlier effect effected effective '
        'effectively efforts either electronic embodied employer enable enables encouraged end enforce '
        'enforcing ensure entered entire entirely entity equivalent erroneously essential even event ever '
        'every everyone exact example except exceptions excluded excluding exclusion exclusive exclusively '
        'excuse executable execute executing exercise exercising expected expects explains explicitly express '
        'expressed expressly extend extended extensions extent f facilitating facilities fail fails failure '
        'fair family fashion favor feature fee file files finally find first fitness fixed flow follow '
        'following for forbid force form format forms found foundation free freedom freedoms from fsf '
        'fulfilling full functioning fundamentally further future general generally generate get give given '
        'gives giving gnu governed gpl grant granted grants gratis greatest guarantee gui had has have having '
        'heartened hereafter holder holders hope hosts household how however html https hypothetical idea '
        'identifiable if implement implementation implied import importing impose imposed improvements in '
        'inability inaccurate inc incidental include included includes including inclusion incompatible '
        'incorporate incorporating incorporation indemnification independent indicate indicating individual '
        'individuals industrial inform information infringe infringed infringement initiate inside install '
        'installation installed instead intact intended intention interacting interaction interactive '
        'interchange interest interface interfaces interfered interpretation interpreter intimate into '
        'invalidate irrevocable is it item its itself june keep kernel key keys kind kinds know knowingly '
        'knowledge language larger later law laws lawsuit least legal lesser letting lgpl liability liable '
        'libraries library license licensed licensee licensees licenses licensing licensors like likewise '
        'limit limitation limited limiting line link linked linking list litigation local long loss losses '
        'machine made mail maintain major make makes making manner manufacturer many march marked marks masks '
        'material materially may meaning means measure measures medium meet meets menu merchantability mere '
        'merging met methods might misrepresentation mode model modification modifications modified modifies '
        'modify modifying more moreover most must name names nature necessary need needed neither network new '
        'next no non noncommercially nor normal normally not nothing notice notices notifies notify '
        'notwithstanding number numbered object obligate obligated obligations occasionally occurring occurs '
        'of offer offered offering official on one only operate operated operating operation opportunity '
        'option options or order org organization organizations origin original other others otherwise our '
        'out output outside own owned packaged packaging paper paragraph paragraphs part particular parties '
        'parts party pass password patent patents pattern payment peer peers performance performing '
        'permanently permission permissions permissive permit permits permitted perpetuity personal pertinent '
        'physical physically pieces place please plus pointer portion possesses possession possibility '
        'possible power practical practice preamble precise precisely predecessor preferred present presents '
        'preservation prevent prevented previous price primarily prior private problems procedures procuring '
        'produce product products program programmer programming programs prohibit prohibiting prohibits '
        'prominent prominently propagate propagating propagation property proprietary protect protecting '
        'protection protocols prove provide provided provision provisionally proxy public publicity publicly '
        'publish published purpose purposes pursuant qualify quality read readable readily reading ready '
        'reason reasonable receipt receive received receives receiving recipient recipients recognized '
        'redistribute referring refers refrain regard regardless regenerate reinstated relationship released '
        'releasing relevant relicensing relying remain remains remote remotely removal remove render rendered '
        'repair represent require required requirement requirements requires requiring resolved respect '
        'responsibilities responsible restrict restricting restriction restrictions result resulting results '
        'retains return reviewing revised right rights risk rom royalty rules run running runs s safest sake '
        'sale same satisfy saying school scope scripts secondarily secondary section sections see sell '
        'selling semiconductor separable separate separately server servers serves service servicing shall '
        'share shared short should show sign significant similar simultaneously single so software sold sole '
        'solely some source spare speak special specific specifically specified specifies specify spirit '
        'stand standard standards start starts state stated statement states stating status steps storage '
        'subdividing subject sublicenses sublicensing subprograms subroutine subsection substantial '
        'substantially such sue suffice supplement support supports sure surrender survive sustained system '
        'systematic take tangible technological tells term terminal terminate terminated terminates '
        'termination terms than that the their them then there therefore these they things third this those '
        'though threatened three through thus time to too tools trade trademark trademarks transaction '
        'transfer transferred transferring transmission treated treaty two type typical unacceptable under '
        'unless unlimited unmodified unnecessary unpacking until updates use used useful user users uses '
        'using valid verbatim version versions view violates violation visible void volume w waive waiver '
        'want warranties warranty was way ways we welcome well were what whatever when where whether which '
        'who whole whom whose why widely widespread will window wipo wish with within without work working '
        'works worldwide would writing written www year years you your yourself '
    ),
    "Apache-2.0": (
        '0 1 2 2004 3 4 5 50 6 7 8 9 a above acceptance accepting act acting acts add addendum additional '
        'additions advised against agree agreed agreement all alleging alone along alongside also an and '
        'annotations any apache appear appendix applicable applies apply appropriate appropriateness archives '
        'are arising as asserted associated assume at attach attached attribution authorized authorship '
        'available b based basis be been behalf below beneficial bind boilerplate brackets but by c cannot '
        'carry cause changed character charge choose claim claims class code combination comment commercial '
        'common communication compiled compliance complies computer conditions configuration consequential '
        'consistent conspicuously constitutes construed contained content contents contract contribution '
        'contributions contributor contributory control controlled conversions copies copy copyright '
        'counterclaim cross customary d damages date defend defined definition definitions deliberate '
        'derivative derived describing description designated determining different direct direction '
        'disclaimer discussing display distribute distributed distribution do document documentation does don '
        'each easier editorial either elaborations electronic enclosed end entities entity even event example '
        'except excluding exclusive executed exercise exercising explicitly express failure fee fields fifty '
        'file filed files fitness following for form format free from generated give goodwill governing grant '
        'granted granting grants grossly harmless has have hereby herein hold how however http i '
        'identification identifying if ii iii implied import improving in inability incidental include '
        'included includes including inclusion incorporated incurred indemnify indemnity indicated indirect '
        'individual information informational infringed infringement institute intentionally interfaces '
        'irrevocable is issue its january kind language law lawsuit least legal liability liable licensable '
        'license licensed licenses licensor limitation limitations limited link lists litigation loss losses '
        'made mailing make making malfunction managed management marked marks may mean means mechanical media '
        'medium meet merchantability merely modifications modified modify modifying more must name names '
        'necessarily negligence negligent no non normally not nothing notice notices notwithstanding object '
        'obligations obtain of offer on one only or org origin original other otherwise out outstanding own '
        'owner ownership page part particular party patent percent perform permission permissions perpetual '
        'pertain places possibility power preferred prepare printed product prominent provide provided '
        'provides publicly purpose purposes readable reason reasonable received recipients recommend '
        'redistributing redistribution regarding remain replaced represent representatives reproduce '
        'reproducing reproduction required responsibility responsible result resulting retain revisions '
        'rights risks royalty s same section sections see sell sent separable separate service shall shares '
        'should software sole solely source special specific state stated statement stating stoppage subject '
        'sublicense submission submit submitted subsequently such supersede support syntax systems t '
        'terminate terms text that the their then theory thereof third this those through title to tort '
        'tracking trade trademark trademarks transfer transformation translation types under union unless use '
        'using verbal version warranties warranty was we where wherever whether which while whole whom with '
        'within without work works worldwide writing written www you your yyyy '
    ),
    "CC0-1.0": (
        '0 1 11 1996 2 3 4 9 96 a abandoned abandons absence account accuracy acknowledges action adapt '
        'addition additional advertising affected affirmer affirms against all amended an and any applicable '
        'applied apply are arising as assert associated associating at attorney author authorship '
        'automatically available b based basis be below benefit build but by c can cancellation case causes '
        'cc0 certain claims clearing client code commercial commons communicate compensation competition '
        'concerning confer consents consideration contemplated contrary contravention contribute contributing '
        'copies copyright corporation corresponding council create creative creator cultural culture current '
        'd damages data database databases date deemed defects defined depicted detriment directive '
        'disclaimers disclaims discoverable display disrupt dissemination distribute distribution document '
        'does duration duty each ec effect effective efforts either elects enjoyment equitable equivalent '
        'errors european exclusive exercise existing expectation express extensions extent extraction '
        'fallback fear firm fitness following for form free freely from fully further future gain grants '
        'greater greatest has he heirs held her hereby hereunder his i ideal ii iii image implementation '
        'implementations implied in include including incorporate ineffective ineffectiveness information '
        'infringement intended intending into invalid invalidate invalidity irrevocable irrevocably is its iv '
        'judged jurisdictions kind knowledge known large latent later law laws legal legally liability '
        'license licensed likeness limitation limitations limited made makes march maximum may meaning medium '
        'member merchantability modify moral most motivations national necessary neighboring no non not now '
        'number obligation obtaining of offers on or original other others otherwise overtly owner owners '
        'paragraph parliament part partial particular party patent perform performer permanently permissible '
        'permissions permitted person persons pertaining possible present preserved privacy production '
        'promote promotional protected protecting protection provide provided provides public publicity '
        'publicly purpose purposes quiet reason redistribute regarding regards related relationship reliably '
        'relinquish remainder remaining representations reproduce reputation required rescission respect '
        'responsibility resulting retained reuse revocation right rights royalty s scientific services shall '
        'she should similar so statement statutory subject sublicensable subsequent successor successors such '
        'surrendered surrenders taking termination terms territories that the their then thereof these this '
        'those through throughout time title to trademark transferable translate treaty unconditional '
        'unconditionally under understands unfair universal unknown upon use v version vi vii voluntarily '
        'waived waiver waives warranties was well whatsoever whether will wish with without work works world '
        'worldwide '
    ),
    "GPL-2.0": (
        '0 02110 1 10 11 12 1301 1989 1991 2 3 4 5 51 6 69 7 8 9 a above absence absolutely accept acceptance '
        'access accompanies accompany accord achieve act actions activities add addition address addressed '
        'advised aggregation agreed agreement all allegation allowed along also alter alternative among an '
        'and announcement another any anyone anything applicable application applications applies apply '
        'appropriate appropriately april are arising as ask associated assume at attach attempt author '
        'authors automatically avoid away b balance based be because been being believed below best binary '
        'body boston both brief bring but by c called can cannot carry case cause certain change changed '
        'changing charge choice choose circumstance circumstances claim claims clear clicks code collective '
        'comes commands commit compelled compilation compiler compilers complete compliance component '
        'components concerns conditions consequence consequential consider considered consistent '
        'conspicuously constantly constitute contact containing contains contents contest contradict contrast '
        'contributions control convey coon copies copy copying copyright copyrighted correction corresponding '
        'cost could countries counts course court covered customarily damages danger data date decide '
        'decision defective definition deny depends derivative derivatives derived designated designed detail '
        'details develop differ different directly disclaimer disclaims display distinguishing distribute '
        'distributed distributing distribution do document does donor each effect effectively either '
        'electronic else employer end enforcing entire entirely equivalent even event ever every everyone '
        'example except exception exceptions exchange excluded excluding exclusion excuse executable exercise '
        'explicit expressed expressly extend extent failure fee fifth file files finally fitness floor follow '
        'following for forbid form forming found foundation franklin free freedom from full further general '
        'generally generous geographical get give given gives gnomovision gnu goals granted grants gratis '
        'greatest guarantee guided hacker has have having he held here hereby herein hereinafter holder '
        'holders hope how however hypothetical idea identifiable if implemented implied impose imposed in '
        'inability inaccurate inc incidental include included including incorporate incorporates '
        'incorporating independent indicate indirectly individually induce information infringe infringement '
        'installation instead intact integrity intended intent interactive interactively interchange interest '
        'interface interfaces into introduced invalid is issues it items its itself james judgment june keep '
        'kernel kind know language later law least legal lesser liable library license licensed licensee '
        'licensees licenses licensor like limitation limited line linking long loss losses ma machine made '
        'mail major make makes making many may means medium meet menu merchantability mere mode modification '
        'modifications modified modify modifying modules more most mouse must name names necessary need new '
        'no noncommercial normally not nothing notice notices number object obligations obtain of offer '
        'offering on one only operate operating option or order ordinary original other others otherwise our '
        'ours out output outside paper part particular parties parts party passed passes patent patents '
        'people performance performing permission permissions permit permitted pertinent physical physically '
        'pieces place placed places plus pointer portion possibility possible practices preamble precise '
        'preferred present preserving president prevent price print problems program programmer programs '
        'prohibited prominent promoting property proprietary protect protecting protection prove provide '
        'provided public publish published purpose quality range rather readable reads reason reasonably '
        'receive received receives recipient recipients redistribute redistribution redistributors refer '
        'referring refers reflect refrain regardless reliance remain rendered repair reputations required '
        'requirements responsibilities responsible rest restricted restrictions reuse revised right rights '
        'risk royalty run running runs s safest same sample satisfy say saying school scope scripts section '
        'sections see separate service servicing share sharing she short should show sign signature signed '
        'similar simultaneously since so software sole some someone something sometimes source speak special '
        'specifies specify spirit start started starts stated stating status steps storage street subject '
        'sublicense subroutine subsection such suits sure surrender sustained system take telling term '
        'terminate terminated terms than that the their them themselves then there therefore thereof these '
        'they things third this thoroughly those though threatened three through thus time to too '
        'transferring translate translated translation true two ty type under understands unenforceable '
        'unless up usa use used useful user users using valid validity verbatim version versions vice view '
        'void volume w want warranties warranty way we welcome what whatever when where whether which who '
        'whole whose wide will willing wish with without work works would write writing written wrote year '
        'years you your yoyodyne '
    ),
    "GPL-3.0": (
        '0 1 10 11 12 13 14 15 16 17 1996 2 20 2007 28 29 3 30 4 5 6 60 6b 6d 7 8 9 a ability about above '
        'absence absolute absolutely abuse accept acceptance access accessible accompanied accompanies accord '
        'according achieve acknowledges acquired across actions activities activity actual actually adapt add '
        'added additional address addressed adopted adversely advised affects affero affirmed affirms after '
        'against aggregate agree agreed agreement aim all alleging allow allowed along already also '
        'alternative although among an ancillary and anti any anyone anything applicable applications applied '
        'applies apply appropriate appropriately approximates are area arise arising arrange arrangement '
        'article as asking assert assets associated assume assumption assumptions assures at attach attempt '
        'attributed attributions author authorization authorized authorizes authorizing authors automatic '
        'automatically available avoid away b based basic be because been behalf being believe below benefit '
        'best between beyond body both box brief business but by c called can cannot carry case cases cause '
        'cease certain cessation change changed changing characterized charge choose choosing circumstances '
        'circumvention civil claim claims class clear clearly closely code collect combination combine '
        'combined comes commands commercial commitment common communication compilation compilations compiler '
        'compliance comply component computer computers concerning concerns conditioned conditions connection '
        'consequence consequential consider considered consistent conspicuously constantly constitutes '
        'construed consumer contact contain containing contains content contents context continue continued '
        'contractual contradict contrast contributor control controlled convenient convey conveyance conveyed '
        'conveying conveys copies copy copying copyleft copyright copyrightable copyrighted correction '
        'corresponding cost could counterclaim countries country course court courts covenant coverage '
        'covered criterion cross cure customarily customer d damages danger data date days december decide '
        'declining deemed defective defenses defined definition definitions denied denominated deny denying '
        'deprive designated designed detail details determining develop developers development devices differ '
        'different differently direction directions directly disclaim disclaimer disclaiming discriminatory '
        'display displayed displays distinguishing distribute distributed distributing distribution do '
        'document documented does domains doubtful downstream durable dwelling dynamically e each earlier '
        'effect effected effective effectively efforts either electronic embodied employer enable enables end '
        'enforce enforcing ensure entered entire entirely entity equivalent erroneously essential even event '
        'ever every everyone exact example except exceptions excluded excluding exclusion exclusive '
        'exclusively excuse executable execute executing exercise exercising expected expects explains '
        'explicitly express expressed expressly extend extended extensions extent f facilities fails failure '
        'fair family fashion favor feature fee file files finally find first fitness fixed flow follow '
        'following for forbid force form format forms found foundation free freedom freedoms from fsf '
        'fulfilling full functioning fundamentally further future general generally generate get give given '
        'gives giving gnu governed gpl grant granted grants gratis greatest guarantee gui had has have having '
        'hereafter holder holders hope hosts household how however html https hypothetical idea identifiable '
        'if implement implementation implied import importing impose imposed in inability inaccurate inc '
        'incidental include included includes including inclusion incompatible incorporating incorporation '
        'indemnification independent indicate indicating individual individuals industrial inform information '
        'infringe infringed infringement initiate inside install installation installed instead intact '
        'intended intention interaction interactive interchange interest interface interfaces interfered '
        'interpretation interpreter intimate into invalidate irrevocable is it item its itself june keep '
        'kernel key keys kind kinds know knowingly knowledge language larger later law laws lawsuit least '
        'legal lesser lgpl liability liable libraries library license licensed licensee licensees licenses '
        'licensing licensors like likewise limit limitation limited limiting line link linked linking list '
        'litigation local long loss losses machine made mail maintain major make makes making manner '
        'manufacturer march marked marks masks material materially may meaning means measure measures medium '
        'meet meets menu merchantability mere merging met methods might misrepresentation mode model '
        'modification modifications modified modifies modify modifying more moreover most must name names '
        'nature necessary need needed neither network new next no non noncommercially nor normal normally not '
        'nothing notice notices notifies notify notwithstanding number numbered object obligate obligated '
        'obligations occasionally occurring occurs of offer offered offering official on one only operate '
        'operated operating operation option options or order org organization organizations origin original '
        'other others otherwise our out output outside own owned packaged packaging paper paragraph '
        'paragraphs part particular parties parts party pass password patent patents pattern payment peer '
        'peers performance performing permanently permission permissions permissive permit permits permitted '
        'perpetuity personal pertinent physical physically pieces place please plus pointer portion possesses '
        'possession possibility possible power practical practice preamble precise precisely predecessor '
        'preferred present presents preservation prevent prevented previous price primarily prior private '
        'problems procedures procuring produce product products program programmer programming programs '
        'prohibit prohibiting prohibits prominent prominently propagate propagating propagation property '
        'proprietary protect protecting protection protocols prove provide provided provision provisionally '
        'proxy public publicity publicly publish published purpose purposes pursuant qualify quality read '
        'readable readily reading ready reason reasonable receipt receive received receives receiving '
        'recipient recipients recognized redistribute referring refers refrain regard regardless regenerate '
        'reinstated relationship released relevant relicensing relying remain remains removal remove render '
        'rendered repair represent require required requirement requirements requires requiring resolved '
        'respect responsibilities responsible restrict restricting restriction restrictions result resulting '
        'results retains return reviewing revised right rights risk rom royalty rules run running runs s '
        'safest sake sale same satisfy saying school scope scripts secondarily section sections see sell '
        'selling semiconductor separable separate separately server serves service servicing shall share '
        'shared short should show sign significant similar simultaneously single so software sold sole solely '
        'some source spare speak special specific specifically specified specifies specify spirit stand '
        'standard standards start starts state stated statement states stating status steps storage '
        'subdividing subject sublicenses sublicensing subprograms subroutine subsection substantial '
        'substantially such sue suffice supplement support supports sure surrender survive sustained system '
        'systematic take tangible technological tells term terminal terminate terminated terminates '
        'termination terms than that the their them then there therefore these they things third this those '
        'though threatened three through thus time to too tools trade trademark trademarks transaction '
        'transfer transferred transferring transmission treated treaty two type typical unacceptable under '
        'unless unlimited unmodified unnecessary unpacking until updates use used useful user users uses '
        'using valid verbatim version versions view violates violation visible void volume w waive waiver '
        'want warranties warranty was way ways we welcome well were what whatever when where whether which '
        'who whole whom whose why widely will window wipo wish with within without work working works '
        'worldwide would writing written www year years you your yourself '
    ),
    "LGPL-2.1": (
        '0 02110 1 10 11 12 13 1301 14 15 16 1990 1991 1999 2 2d 3 4 5 51 6 6a 7 8 9 a able about above '
        'absence accept acceptance access accessors accompanies accompany accompanying achieve act actions '
        'activities add addition address addressed advantage advantages advised affected after aggregation '
        'agreed agreement all allegation allowed along already also alter alternatively although among an and '
        'another any anything appeared applicable application applies apply appropriate appropriately april '
        'are argument arising as ask associated assume at attach attempt attention author authorized authors '
        'automatically away b balance based be because becomes been being believed below better between '
        'binary body boston both brief bring but by c call called can cannot carefully carry case cases cause '
        'certain change changed changes changing charge choice choose circumstance circumstances claim claims '
        'clear close code collection collective combination combine combined company compatible compelled '
        'competing compilation compiled compiler complete compliance component components compute computer '
        'concerns conditions consequence consequential considered consistent conspicuously constant '
        'constitute contact containing contains contents contest contradict contradiction contradicts '
        'contrast contributions control conveniently convey coon copies copy copying copyright copyrighted '
        'correction corresponding cost could countries counts court covered creates criteria customarily '
        'customer d damages data date de debugging decide decision defective defined definition definitions '
        'deny depends derivative derivatives derived designated designed detail details develop developers '
        'differ difference different directing directly disadvantages disclaimer disclaims displays '
        'distinguishing distribute distributed distributing distribution distributor distributors do document '
        'does donor during e each effectively effort either electronic else employer enables encourage end '
        'enforcing engineering ensure entire entirely equivalent especially even event ever every everyone '
        'example except exception exceptions exchange excluded excluding exclusion excuse executable '
        'executables execution exercise existence explaining explanations explicit expressed expressly extend '
        'extent facilities facility fact facto failure faith fall falls february fee fifth file files finally '
        'find first fitness fits floor follow following for forbid form former forming found foundation '
        'franklin free freedom frequent frob from full function functions further gain gave general generally '
        'generous geographical get give given gives gnu goals good gpl granted grants gratis greater greatest '
        'guarantee guided hacker happen has have he header held hence here hereby herein hereinafter holder '
        'holders hope how however idea identifiable if implemented implied impose imposed in inability '
        'inaccurate inc incidental include included including incompatible incorporate incorporates '
        'independent indicate indirectly induce information informed infringe infringement inline insist '
        'installation installs instead intact integrity intended intent interchange interest interface '
        'interfaces into introduced invalid invoked irreversible is isolation issues it its itself james job '
        'judgment keep kernel kind knobs know language large later latter law lax layouts least legal legally '
        'length less lesser liable libraries library license licensed licensee licensees licenses licensor '
        'limitation limited limiting line lines link linked linking linux little long loss losses ma machine '
        'macros made mail major make making many material materials may meaningful means mechanism medium '
        'meet merchantability mere method might modification modifications modified modify modifying modules '
        'more most must name names necessarily necessary need needed new newer no non normally not nothing '
        'notice notices number numerical object obligations obtained obtaining occasions of offer offering on '
        'once one only operate operates operating opt option optional or order ordinary original other others '
        'otherwise our out output outside over own packages paper parameters part particular parties parts '
        'party passed patent patents pay people performance performing performs permission permissions permit '
        'permits permitted permitting pertinent physical pieces place placed places plus pointer portion '
        'portions pose possibility possible practices preamble precise precisely preferred prepared present '
        'preserving president price problems produce program programmer programs prohibited prominent '
        'promoting properly property proprietary protect protecting protection protective prove provide '
        'provided provides public publish published purpose quality quite random range rare rather readable '
        'reason reasonably receive received receives recipient recipients recommend recompile recompiling '
        'redistribute redistribution refer reference referring refers refrain regardless released reliance '
        'relink remain remains rendered repair reproducing reputation required requirement requirements '
        'requires responsibilities responsible rest restrict restricted restrictions restrictive reuse '
        'reverse revised right rights risk root roots royalty run running runs s safest same sample satisfies '
        'satisfy say saying school scope scripts section sections see sent separate service servicing share '
        'shared sharing she should show side sign signature signed significant similar simultaneously since '
        'single small so software sole some someone sometimes source speak speaking special specially '
        'specified specifies specify spirit square standard start stated states statically stating status '
        'step still storage straightforwardly strategy street structure subject sublicense subsection '
        'subsequent successor such suggest suitable supplied supply sure surrender sustained system table '
        'take ten term terminate terminated terms than that the their them themselves then there therefore '
        'these they things think third this thoroughly those though threat three threshold through thus time '
        'to together too tool transferring translate translated translation true tweaking two ty typically '
        'uncombined under understood unenforceable unless unrestricted up usa use used useful user users uses '
        'using utility valid validity variant verbatim verify version versions very vice void volume want '
        'warranties warranty was way we well were what whatever when where whereas wherewithal whether which '
        'who whole whose wide widely widest will willing wish with without work works would write writing '
        'written wrote year years you your yoyodyne '
    ),
    "LGPL-3.0": (
        '0 1 2 2007 29 3 4 4d0 4d1 5 6 a acceptance accessors accompany accompanying additional address '
        'allowed already also among an and any applicable application applications applies apply are argument '
        'as at authorization b based be being below both bound but by c called can certain changing choice '
        'choose class code combined combining compatible computer concerns conditions considered contained '
        'convey conveyed conveying copies copy copyright corresponding covered d data debugging decide deemed '
        'defined defining definitions detail differ directing displays distinguishing distribute do document '
        'does during e each effectively effort either engineering ensure event ever everyone exception '
        'excluding execute execution explaining extent facilities facility faith fewer file files find '
        'following for form foundation free from fsf function functions future general give given gnu good '
        'governed gpl have header herein https if in inc include including incorporate incorporated '
        'incorporates incorporating information inline install installation interface invoked is isolation it '
        'its june later layouts length lesser libraries library license limited lines linked linking listed '
        'macros made make makes manner material may meaningful means mechanism minimal mode modification '
        'modifications modified modify must necessary needed new none not notice notices number numbered '
        'numerical object of on one only operate operates option or org other otherwise parameters part '
        'particular passed performs permanent permissions permit permitted place portions present problems '
        'produce produced programs prominent properly provide provided proxy public publish published purpose '
        'received recombine recombining reference refers relink relinking remains reproducing required '
        'restrict reverse revised run s same section sections shall shared side similar single small software '
        'source specified specifies specify spirit statement still structure subclass such suitable '
        'supplemented supplied supply system taken templates ten terms than that the then these this time to '
        'together uncombined under use used user uses using utility verbatim version versions was well '
        'whatever when where whether which will with without work works would you your '
    ),
    "MPL-2.0": (
        '0 1 10 11 12 13 14 2 3 30 4 5 50 6 60 7 8 9 a ability able above absence absolutely accurate actions '
        'add addition additional additionally affect affero after against agree agreement agreements all '
        'alleging allow alone also alter an and any anyone apparatus applicable application apply are as '
        'asserting assume at attached attempt authorized automatically available b back basis be become been '
        'behalf believes beneficial bring brought business but by c can case cause caused character charge '
        'choice choose circumstances claim claims clear code combination combines come commercial common '
        'complete compliance compliant comply computer concerning conditions conflict consequential '
        'constitutes construe construed contained contains contents contract contribute contributes '
        'contribution contributions contributor contributors control controlled controls conveyed copy '
        'copyright correction cost counter courts covered create creates creation cross damages date days '
        'dealing death declaratory defective defects defendant defined definition definitions deletion '
        'describe described description desirable detailed different differs direct direction directly '
        'directory disclaimer disclaimers display distinguishing distribute distributed distributes '
        'distributing distribution distributions distributors do doctrines document does drafter due each '
        'earlier effect effective either end enforceable entire entities entity equivalents essential even '
        'event every except excluding exclusion exclusive executable exercising exhibit explicitly exploit '
        'expressed extent factual fail fails failure fair fee fifty file files finally first fit following '
        'for form foundation free from further general given gnu goodwill governed grant granted grants has '
        'have having held hereby hereof how however http i if ii implied import impossible in inability '
        'inaccuracies incidental include included includes including incompatible incurred indemnify '
        'indemnity indirect indirectly individual inform informed infringed infringement infringements '
        'infringes infringing initial initiate injury intellectual intended into is it its judgment judicial '
        'jurisdiction jurisdictions kind known language larger later law laws legal lesser liability liable '
        'licensable license licenses licensing likely limit limitation limitations litigation location logos '
        'look loss losses lost made maintains make makes making malfunction management manner marks material '
        'matter maximum may means merchantable method miscellaneous modification modifications modified '
        'modify more moreover mozilla mpl must name necessary negligence new no non not note nothing notice '
        'notices notifies notify notwithstanding number obligation obligations obtain of offer offered '
        'offering on one ongoing only option or order ordinary org original originally other others otherwise '
        'outstanding own ownership owns part particular party patent percent perform performance permits '
        'permitted personal place placed portions possibility possible power preferred prevent principal '
        'prior process profits prohibited prohibits property prove provided provides provision provisionally '
        'provisions public publish published purpose purposes put quality reasonable receipt received '
        'recipient recipients reference references reformed regulation reinstated relating relevant remedy '
        'remove removed rename repair representation represents reproduce required requirements resellers '
        'respect responsibilities restrict result resulting results right rights risk royalty s sale scope '
        'secondary section sections see sell selling separate service servicing shall shares should skill so '
        'software some source special specific statute statutory steward stoppage subject sublicense '
        'subsequent subsequently substance such sufficient sufficiently support survive terminate terminates '
        'termination terms text than that the their then theory thereof they third this those time timely to '
        'tort trademark trademarks transfer under understand unenforceable unless unmodified until use used '
        'user using v validly version versions want warranties warranty was where whether which who wide will '
        'with within without work world would you your '
    ),
}
